"""Licence scans by sentence rules.

A text is cut in sentences, which may run over several lines, and each is normalised. Sentences that are known from licence
texts are mapped to identifiers; the identifiers of a document, in order, are then matched
against ordered licence rules: a rule that matches takes its identifiers, so that an
exception or a longer licence, listed first, is not read again as the plain one. All of it is
column expressions and one join with the known sentences, whose number is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences (lower case, letters and digits, single spaces) and what they are.
SENTENCES = {
    "apache2-licensed": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"],
    "apache2-comply": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at"],
    "apache2-as-is": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "apache2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit-named": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "this project is licensed under the mit license see the license file for details", "this project is licensed under the terms of the mit license", "licensed under the mit license see license for details", "the mit license", "mit license", "spdx license identifier mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is-mit": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "gpl3-work": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "licensed under the gnu general public license v3 0", "licensed under gpl v3"],
    "gpl2-work": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl3-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl-see": ["see the gnu general public license for more details"],
    "gpl-received": ["you should have received a copy of the gnu general public license along with this program"],
    "classpath-exception": ["as a special exception the copyright holders of this library give you permission to link this library with independent modules to produce an executable"],
    "lgpl21-work": ["licensed under the gnu lesser general public license version 2 1", "this work is licensed under the gnu lesser general public license version 2 1"],
    "lgpl3-work": ["this work is licensed under the gnu lesser general public license version 3", "licensed under the gnu lesser general public license version 3"],
    "lgpl21-free": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"],
    "lgpl3-free": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl-hope": ["this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "lgpl-see": ["see the gnu lesser general public license for more details"],
    "agpl3-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "agpl-see": ["see the gnu affero general public license for more details"],
    "gpl-part": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl-part": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "either-2": ["either version 2 of the license or at your option any later version"],
    "either-21": ["either version 2 1 of the license or at your option any later version"],
    "either-3": ["either version 3 of the license or at your option any later version"],
    "epl2": ["this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0", "spdx license identifier epl 2 0"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "bsl-title": ["distributed under the boost software license version 1 0", "boost software license version 1 0"],
    "spdx-apache2": ["spdx license identifier apache 2 0"],
    "spdx-bsd2": ["spdx license identifier bsd 2 clause"],
    "spdx-bsd3": ["spdx license identifier bsd 3 clause"],
    "spdx-gpl2": ["spdx license identifier gpl 2 0", "spdx license identifier gpl 2 0 only"],
    "spdx-gpl2-later": ["spdx license identifier gpl 2 0 or later"],
    "spdx-gpl3": ["spdx license identifier gpl 3 0", "spdx license identifier gpl 3 0 only"],
    "spdx-gpl3-later": ["spdx license identifier gpl 3 0 or later"],
    "spdx-lgpl21-later": ["spdx license identifier lgpl 2 1 or later"],
    "spdx-lgpl3-later": ["spdx license identifier lgpl 3 0 or later"],
    "spdx-agpl3-later": ["spdx license identifier agpl 3 0 or later"],
    "spdx-isc": ["spdx license identifier isc"],
    "spdx-mpl2": ["spdx license identifier mpl 2 0"],
    "spdx-cc0": ["spdx license identifier cc0 1 0"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-named": ["licensed under the bsd license", "released under the bsd license", "licensed under the bsd 3 clause license"],
    "mpl2-subject": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl2-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license", "licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4 0"],
    "cc0": ["licensed under cc0 1 0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "this work is in the public domain", "released into the public domain"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "reserved": ["all rights reserved"],
    "proprietary": ["unauthorized copying of this file via any medium is strictly prohibited", "proprietary and confidential"],
}

# Licences and the identifiers they are made of, in the order in which they are tried.
RULES = [
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ["gpl2-free", "classpath-exception"]),
    ("GPL-3.0-or-later", ["gpl3-free", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-3.0-or-later", ["gpl3-free"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-see", "gpl-received"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("GPL-2.0-only", ["gpl2-work"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope", "lgpl-see"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-2.1-or-later", ["lgpl-part", "either-21"]),
    ("LGPL-2.1-or-later", ["spdx-lgpl21-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-free", "lgpl-hope", "lgpl-see"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("LGPL-3.0-or-later", ["lgpl-part", "either-3"]),
    ("LGPL-3.0-or-later", ["spdx-lgpl3-later"]),
    ("LGPL-2.1-only", ["lgpl21-work"]),
    ("LGPL-3.0-only", ["lgpl3-work"]),
    ("AGPL-3.0-or-later", ["agpl3-free", "gpl-hope", "agpl-see"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("AGPL-3.0-or-later", ["spdx-agpl3-later"]),
    ("GPL-2.0-or-later", ["gpl-part", "either-2"]),
    ("GPL-3.0-or-later", ["gpl-part", "either-3"]),
    ("GPL-3.0-or-later", ["spdx-gpl3-later"]),
    ("GPL-2.0-or-later", ["spdx-gpl2-later"]),
    ("GPL-3.0-only", ["spdx-gpl3"]),
    ("GPL-2.0-only", ["spdx-gpl2"]),
    ("Apache-2.0", ["spdx-apache2"]),
    ("BSD-3-Clause", ["spdx-bsd3"]),
    ("BSD-2-Clause", ["spdx-bsd2"]),
    ("EPL-2.0", ["epl2"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["bsl-title"]),
    ("ISC", ["spdx-isc"]),
    ("MPL-2.0", ["spdx-mpl2"]),
    ("CC0-1.0", ["spdx-cc0"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-comply", "apache2-copy", "apache2-as-is", "apache2-see"]),
    ("Apache-2.0", ["apache2-licensed"]),
    ("MIT", ["mit-named", "mit-grant", "mit-notice", "as-is-mit"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is-mit"]),
    ("MIT", ["mit-named"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD", ["bsd-named"]),
    ("MPL-2.0", ["mpl2-subject", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC0-1.0", ["cc0"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense"]),
    ("Proprietary", ["proprietary"]),
    ("Proprietary", ["reserved"]),
]

#: A rule of only these says something where no other rule matches: licences that permit much reserve rights as well.
YIELDING = {"reserved"}


def yields(parts: list[str]) -> bool:
    return set(parts) <= YIELDING

#: A sentence ends at a blank line, or at one of these with white space or the end of the text after it.
SENTENCE_END = "\n[\\x20\\x09-\\x0D]*\n|[.!?;](?:[\\x20\\x09-\\x0D]|$)"


def sentences(text: Column) -> Column:
    """The sentences of a text, in order, with their line ends; blank ones keep their place."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9.!?;\\n\\x20\\x09-\\x0D]+", " ")
    return F.split(plain, SENTENCE_END)


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))


def _known_runs(lines: Column, known: list[str]) -> Column:
    """(start, known) of the runs of a sentence's lines that are known: the first ones, and of these the longest, without overlap."""
    longest, most_lines = max(len(k) for k in known), max(len(k.split()) for k in known)
    starts = sorted({" ".join(w[:n]) for w in (k.split() for k in known) for n in range(1, len(w) + 1)})
    none = F.lit(None).cast("string")

    def run(line: Column, at: Column) -> Column:
        # no known sentence has more lines than words, so the lines looked at bound nothing
        step = lambda acc, x: F.struct(
            F.when(F.length(acc["said"]) > longest, acc["said"]).otherwise(F.ltrim(F.concat(acc["said"], F.lit(" "), x))).alias("said"),
            (acc["n"] + 1).alias("n"), acc["hit"].alias("hit"), acc["size"].alias("size"),
        )
        judge = lambda acc: F.struct(
            acc["said"].alias("said"), acc["n"].alias("n"),
            F.when(acc["said"].isin(known), acc["said"]).otherwise(acc["hit"]).alias("hit"),
            F.when(acc["said"].isin(known), acc["n"]).otherwise(acc["size"]).alias("size"),
        )
        zero = F.struct(F.lit("").alias("said"), F.lit(0).alias("n"), none.alias("hit"), F.lit(0).alias("size"))
        found = F.aggregate(F.slice(lines, at + 1, most_lines), zero, lambda acc, x: judge(step(acc, x)))
        return F.when(line.isin(starts), F.struct(at.alias("start"), found["size"].alias("size"), found["hit"].alias("known")))

    runs = F.filter(F.transform(lines, run), lambda r: r["known"].isNotNull())
    # a run that begins within the one before it is none
    kept = F.aggregate(
        runs,
        F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<start:int,known:string>>").alias("hits")),
        lambda acc, r: F.when(
            r["start"] >= acc["free"],
            F.struct((r["start"] + r["size"]).alias("free"), F.concat(acc["hits"], F.array(F.struct(r["start"].alias("start"), r["known"].alias("known")))).alias("hits")),
        ).otherwise(acc),
    )
    return kept["hits"]


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, at, sentence_id) of every known sentence; ``at`` tells its place in the text.

    A known sentence may be wrapped over lines, or be one or more lines of a longer sentence.
    """
    known = known or SENTENCES
    pairs = [(s, k) for k, own in known.items() for s in own]
    table = docs.sparkSession.createDataFrame(pairs, "known string, sentence_id string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    cut = rows.select("doc_id", "row", F.posexplode(sentences(F.col("text"))).alias("sentence", "raw"))
    lines = F.filter(F.transform(F.split("raw", "\n"), normalised), lambda x: x != "")
    cut = cut.select("doc_id", "row", "sentence", lines.alias("lines")).where(F.size("lines") > 0)
    hits = cut.select("doc_id", "row", "sentence", F.explode(_known_runs(F.col("lines"), sorted({s for s, _ in pairs}))).alias("hit"))
    at = F.struct("sentence", F.col("hit.start").alias("line"))
    return hits.select("doc_id", "row", at.alias("at"), F.col("hit.known").alias("known")).join(F.broadcast(table), "known").drop("known")


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """(doc_id, sentence_ids, licences, unmatched) of every row with a known sentence.

    ``sentence_ids`` lists the identifiers in text order, ``licences`` the matched licences in
    rule order without repeats, ``unmatched`` how many identifiers no rule took. A rule matches
    where its identifiers follow one another, whatever unknown text lies between. Rules of
    yielding identifiers only count where no other rule matches. Null and
    empty texts have no sentences, and rows without known ones are not returned. Repeated rows
    are scanned each for itself; a null id is passed on; other columns are not looked at.
    """
    found = recognised(docs, id_col, text_col, known)
    listed = found.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("at", "sentence_id"))).alias("hits"))
    # the identifiers as one text, each between bars; a match leaves a gap that no rule spans
    ids = F.transform("hits", lambda h: h["sentence_id"])
    seq = listed.select("doc_id", ids.alias("sentence_ids"), F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|")).alias("left"))
    rules = rules or RULES
    names = []
    for i, (_, parts) in enumerate(rules):
        needle = "".join(f"|{p}|" for p in parts)
        seq = seq.withColumn(f"_m{i}", F.contains("left", F.lit(needle))).withColumn("left", F.replace("left", F.lit(needle), F.lit("/")))
        names.append(F.when(F.col(f"_m{i}"), F.lit(rules[i][0])))
    told = lambda weak: F.array_distinct(F.filter(F.array(*(n for n, (_, p) in zip(names, rules) if yields(p) == weak), F.lit(None)), lambda x: x.isNotNull()))
    matched = F.when(F.size(told(False)) > 0, told(False)).otherwise(told(True))
    rest = F.length(F.regexp_replace("left", "[^|]+", "")) / 2
    return seq.select("doc_id", "sentence_ids", matched.alias("licences"), rest.cast("long").alias("unmatched"))
