"""Small fixtures with nulls, empty and long texts, ties, repeated rows and clashing names, against plain versions."""

import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from acopio.llm import licenses, mixing, packing, pages, quality, search, sharding, toxicity, warc
from acopio.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, score double, shard int, row string"


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def documents(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (3, "x", ""), (None, "x y z", "b"), (4, "lone " * 3000, "a")]
    for i in range(5, 60):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 9, 30, 200])))
        rows.append((i, text + rng.choice(["", "\nLine\nLine", " ### $$"]), rng.choice(["a", "a", "b", None, "é"])))
    rows += rows[10:13] * 2
    return rows, spark.createDataFrame([(*r, 1.0, 2, "r") for r in rows], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_revisits(spark):
    at = [datetime(2024, 1, 1, h) for h in range(20)]
    full = lambda i, u, t, e=None, m=None: (i, u, t, "response", 200, e, m, {"date": f"d{i}", "x": "1"})
    again = lambda i, u, t, e=None, m=None, h=None: (i, u, t, "revisit", 304, e, m, h)
    rows = [
        full(1, "http://www.A.com/p/?b=2&a=1&utm_x=3#f", at[1], '"e1"', "m1"), full(2, "https://a.com:443/p?a=1&b=2", at[1], '"e2"', "m1"),
        full(3, "a.com/p?a=1&b=2", None, '"n"'), full(4, None, at[0]), (5, "http://a.com/p?a=1&b=2", at[2], "response", 404, '"bad"', None, None),
        again(10, "http://m.a.com/p/?a=1&b=2", at[3], 'W/"e2"', "other", {"date": "new", "x": "9"}), again(11, "http://a.com/p?a=1&b=2", at[3], '"e1"'),
        again(12, "http://a.com/p?a=1&b=2", at[4], None, "m1"), again(13, "http://a.com/p?a=1&b=2", at[5]), again(14, "http://a.com/p?a=1&b=2", at[1], '"e2"'),
        again(15, None, at[3]), again(16, "http://a.com/p?a=1&b=2", None), again(17, "http://a.com/p/index.html?a=1&b=2", at[19], None, "m2"),
    ]
    schema = "record_id long, url string, captured_at timestamp, kind string, status int, etag string, last_modified string, headers map<string,string>"
    for seconds in (3600, 86_400 * 1000):
        got = {r["record_id"]: (r["verdict"], r["response_id"], r["headers"]) for r in warc.resolve_revisits(spark.createDataFrame(rows, schema).withColumn("bucket", F.lit(0)), seconds).collect()}
        assert got == {
            10: ("resolved", 2, {"date": "new", "x": "1"}), 11: ("changed", 2, None), 12: ("resolved", 2, {"date": "d2", "x": "1"}),
            13: ("unvalidated", 2, {"date": "d2", "x": "1"}), 14: ("orphan", None, None), 15: ("orphan", None, None), 16: ("orphan", None, None), 17: ("changed", 2, None),
        }
    assert warc.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_revisits_without_or_with_repeated_ids(spark):
    at = [datetime(2024, 1, 1, h) for h in range(9)]
    full = lambda i, u, t, e: (i, u, t, "response", 200, e, None, {"x": e})
    again = lambda i, u, t, e: (i, u, t, "revisit", 304, e, None, None)
    rows = [
        full(1, "a.com/p", at[0], "old"), full(None, "a.com/p", at[1], "new"), again(None, "a.com/p", at[2], "new"), again(None, "a.com/p", at[3], "old"),
        full(7, "b.com/p", at[0], "b"), full(7, "c.com/p", at[0], "c"), again(8, "b.com/p", at[2], "b"), again(8, "c.com/p", at[2], "c"), again(8, "c.com/p", at[2], "b"),
        full(None, "d.com/p", at[0], "none"), full(2, "d.com/p", at[0], "two"), again(None, "d.com/p", at[1], "two"), again(None, "e.com/p", at[1], "e"),
    ]
    schema = "record_id long, url string, captured_at timestamp, kind string, status int, etag string, last_modified string, headers map<string,string>"
    for seconds in (3600, 86_400 * 1000):
        got = warc.resolve_revisits(spark.createDataFrame(rows, schema), seconds).collect()
        assert Counter((r["url_key"], r["record_id"], r["captured_at"], r["verdict"], r["response_id"], r["response_at"], (r["headers"] or {}).get("x")) for r in got) == Counter([
            ("a.com/p", None, at[2], "resolved", None, at[1], "new"), ("a.com/p", None, at[3], "changed", None, at[1], None),
            ("b.com/p", 8, at[2], "resolved", 7, at[0], "b"), ("c.com/p", 8, at[2], "resolved", 7, at[0], "c"), ("c.com/p", 8, at[2], "changed", 7, at[0], None),
            ("d.com/p", None, at[1], "resolved", 2, at[0], "two"), ("e.com/p", None, at[1], "orphan", None, None, None),
        ])


def test_licences(spark):
    rows = [
        (1, "Intro text.\nReleased under the MIT License.\nMore"), (2, "Licensed under the Apache License, Version 2.0. Then. RELEASED under the  MIT license!"),
        (3, None), (4, ""), (5, "nothing known here. At all."), (None, "All rights reserved"), (1, "Intro text.\nReleased under the MIT License.\nMore"), (6, "word " * 50_000 + "\nLicensed under CC BY-NC 4.0."),
    ]
    got = licenses.licences(spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, left string"))
    assert Counter((r["doc_id"], tuple(r["sentence_ids"]), tuple(r["licences"]), r["unmatched"]) for r in got.collect()) == Counter({
        (1, ("mit-named",), ("MIT",), 0): 2, (2, ("apache2-licensed", "mit-named"), ("Apache-2.0", "MIT"), 0): 1,
        (None, ("reserved",), ("Proprietary",), 0): 1, (6, ("cc-by-nc",), ("CC-BY-NC-4.0",), 0): 1,
    })
    known, rules = {"a": ["one"], "b": ["two"]}, [("AB", ["a", "b"]), ("A", ["a"])]
    got = licenses.licences(spark.createDataFrame([(1, "one. two. one. x. two. two. one"), (2, "two")], "doc_id long, text string"), known=known, rules=rules)
    assert {r["doc_id"]: (r["licences"], r["unmatched"]) for r in got.collect()} == {1: (["AB", "A"], 1), 2: ([], 1)}
    assert licenses.licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_wrapped_licences(spark):
    parts = {
        "mit": ["mit-grant", "mit-notice", "as-is-mit"], "titled": ["mit-named", "mit-grant"], "bsd": ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"],
        "gpl": ["gpl3-free", "gpl-hope", "gpl-see", "gpl-received"], "isc": ["isc-grant"], "apache": ["apache2-licensed", "apache2-comply", "apache2-copy", "apache2-as-is", "apache2-see"],
    }
    rows = []
    for name, ids in parts.items():
        for width in (30, 72, 80):
            for margin in ("", " * ", "# "):
                own = [licenses.SENTENCES[i][0] + "." for i in ids]
                if name == "titled":
                    own = [own[0][:-1] + "\n" + own[1]]
                lines = [x for s in own for one in s.split("\n") for x in textwrap.wrap(one, width)]
                rows.append((name, "Some words before\n\n" + "\r\n".join(margin + x for x in lines)))
    rows += [("spaced", "The" + " " * 5000 + "MIT license"), ("copy", "You may obtain a copy of the License at\n  http://www.apache.org/licenses/LICENSE-2.0\n\nother"), ("split", "the mit\n\nlicense agreement")]
    got = licenses.licences(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    found = Counter((r["doc_id"], tuple(r["sentence_ids"])) for r in got)
    assert found == Counter({(n, tuple(ids)): 9 for n, ids in parts.items()} | {("spaced", ("mit-named",)): 1, ("copy", ("apache2-copy",)): 1})
    named = {r["doc_id"]: r["licences"] for r in got}
    assert {n: named[n] for n in parts} == {"mit": ["MIT"], "titled": ["MIT"], "bsd": ["BSD-3-Clause"], "gpl": ["GPL-3.0-or-later"], "isc": ["ISC"], "apache": ["Apache-2.0"]}


def toxic_sample(n, seed):
    rng = random.Random(seed)
    common = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rng = random.Random(seed + 1)
    out = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(5, 80))]
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zzxqul", "vwyrrk", "plonkzu"]))
        out.append((" ".join(words), int(i % 4 == 0)))
    return out


def test_toxicity_on_held_out_texts(spark):
    sample = toxic_sample(800, 1)
    model = toxicity.fit(sample[:500])
    rows = [(i, t) for i, (t, _) in enumerate(sample[500:])] + [(None, None), (-1, ""), (-2, "same " * 60_000 + "zzxqul vwyrrk plonkzu " * 2000)]
    got = spark.createDataFrame([(*r, 5.0) for r in rows], "doc_id long, text string, score double").select("doc_id", toxicity.toxicity(F.col("text"), model).alias("p")).collect()
    assert all(0 <= r["p"] <= 1 for r in got)
    by = {r["doc_id"]: r["p"] for r in got}
    right = [(by[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(sample[500:])]
    assert sum(right) / len(right) >= 0.95
    assert by[None] < 0.5 and by[-1] < 0.5 and by[-2] >= 0.5
    for few in ([], [("a b", 1)], [("a b", 0)], [(None, 1), ("", 0)]):
        assert 0 <= toxicity.fit(few).scorer().score("a b") <= 1


def test_sample_leaves_out_unknown_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, 1), (9, 0), (2, None)], "doc_id long, toxic int")
    texts, share = toxicity.labelled_sample(docs, labels)
    assert sorted(texts) == [("a", 1), ("b", 0)] and share == 0.5


@pytest.mark.parametrize("n", [1, 7, 40, 200])
def test_shards(spark, n):
    rows, docs = documents(spark)
    got = sharding.shards(docs, n).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= s < n and sorted(x) == list(range(len(x))) for s, x in slots.items())
    counts = [len(slots.get(s, ())) for s in range(n)]
    assert max(counts) - min(counts) <= 1
    for source, total in Counter(r[2] for r in rows).items():
        for s in range(n):  # fractional ranks keep a source within a row or two of its share
            assert abs(sum(r["shard"] == s and r["source"] == source for r in got) - total * counts[s] / len(rows)) <= 2.5
    assert sharding.shards(docs.limit(0), n).count() == 0


def plain_bm25(rows, queries, k, most, least):
    counted = [search.terms(t) for _, t in rows]
    df = Counter(w for c in counted for w in c)
    mean = max(1.0, sum(c.total() for c in counted) / max(1, len(rows)))
    idf = {w: math.log1p((len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = []
    for qid, text in queries:
        own = [(w, n) for w, n in search.terms(text).items() if df[w] >= least]
        if most:
            number = search._Hasher()
            own = sorted(own, key=lambda x: (-x[1] * idf[x[0]], number[x[0]]))[:most]
        scores = []
        for (doc_id, _), c in zip(rows, counted):
            s = sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for w, _ in own if w in c)
            if s > 0:
                scores.append((-round(s, 6), doc_id is None, doc_id or 0))
        out += [(qid, None if null else d, round(-s, 6)) for s, null, d in sorted(scores)[:k]]
    return Counter(out)


@pytest.mark.parametrize("most, least, shard, block", [(None, 1, 1000, 1000), (6, 2, 9, 5), (None, 1, 7, 20)])
def test_search_against_all_scores(spark, most, least, shard, block):
    rows, docs = documents(spark)
    queries = docs.where("doc_id % 3 = 0 or doc_id is null")
    got = search.search(docs, queries, 5, most, least, docs_per_shard=shard, queries_per_block=block).collect()
    want = plain_bm25([r[:2] for r in rows], [r[:2] for r in rows if r[0] is None or r[0] % 3 == 0], 5, most, least)
    assert Counter((r["query_id"], r["doc_id"], round(r["score"], 6)) for r in got) == want
    assert search.search(docs.limit(0), queries.limit(0)).count() == 0


def test_search_query_asks_for_every_term(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    queries = [r for r in rows if r[0] % 20 == 0]
    assert any(len(search.terms(t)) > 32 for _, t in queries)
    got = QUERIES["op6_bm25_search"](spark, SF).collect()
    assert Counter((r["query_id"], r["doc_id"], r["score"]) for r in got) == plain_bm25(rows, queries, 10, None, 1)


def plain_metrics(text):
    words = plain_words(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    rows, docs = documents(spark)
    extra = ["a b c d e a b c d e f", "é ñ ü ß ö é ñ ü ß ö é", "x " * 40, "l1 a\nl1 a\n\n \nl1 a", "p q r s t u p q r s t v p q r s"]
    rows = rows + [(100 + i, t, "a") for i, t in enumerate(extra)]
    docs = docs.union(spark.createDataFrame([(100 + i, t, "a", 1.0, 1, "n") for i, t in enumerate(extra)], DOCS)).withColumn("n_words", F.lit("clash")).withColumn("length", F.lit(9))
    votes = quality.with_votes(quality.with_metrics(docs))
    judged = quality.judged(votes, quality.learn(votes)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in judged) == Counter((i, *plain_metrics(t)) for i, t, _ in rows)
    for r in judged:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"]) and 0 < r["quality"] < 1
    empty = quality.with_votes(quality.with_metrics(docs.limit(0)))
    assert quality.judged(empty, quality.learn(empty)).count() == 0


def test_em_finds_accuracies():
    rng = random.Random(3)
    patterns = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        right = [(0.97, 0.6), (0.9, 0.8), (0.99, 0.5)]
        patterns[tuple(0 if rng.random() < 0.1 else (1 if (rng.random() < (g if good else 1 - b)) else -1) for g, b in right)] += 1
    w = quality.estimate(sorted(patterns.items()), ["a", "b", "c"])
    assert abs(w.good - 0.8) < 0.05
    for name, (g, b) in zip("abc", [(0.97, 0.6), (0.9, 0.8), (0.99, 0.5)]):
        assert abs(w.chances[name][1][0] - g) < 0.05 and abs(w.chances[name][-1][1] - b) < 0.12


@pytest.mark.parametrize("capacity, per_source, group", [(50, 1, 1000), (50, 2, 10), (4096, 4, 1000)])
def test_packing(spark, capacity, per_source, group):
    rows, docs = documents(spark)
    got = packing.pack(packing.clusters(docs), capacity, per_source, group).collect()
    words, pieces = Counter(), Counter()
    for r in got:
        words[r["doc_id"]] += r["n_words"]
        pieces[r["doc_id"]] += 1
    assert words == Counter({i: sum(len(plain_words(t)) for j, t, _ in rows if j == i) for i, *_ in rows})
    assert sum(pieces.values()) == sum(max(1, -(-len(plain_words(t)) // capacity)) for _, t, _ in rows)
    bins = defaultdict(list)
    for r in got:
        bins[r["bin"]].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r["place"])
        assert [r["place"] for r in held] == list(range(len(held))) and sum(r["n_words"] for r in held) <= capacity
        assert all(a["start"] + a["n_words"] == b["start"] for a, b in zip(held, held[1:]))
        assert all(n <= per_source for s, n in Counter(r["source"] for r in held).items() if s is not None)
        assert all(n == 1 for c, n in Counter(r["cluster"] for r in held).items() if c is not None)
    assert packing.pack(packing.clusters(docs.limit(0))).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = random.Random(8)
    items = [(rng.randint(0, 30), rng.choice("abc"), rng.choice([None, 1, 2, 3])) for _ in range(200)]
    bins = []
    want = [0] * len(items)
    for at in sorted(range(len(items)), key=lambda i: -items[i][0]):
        n, s, c = items[at]
        fits = [(b["room"], k) for k, b in enumerate(bins) if b["room"] >= n and b["room"] and b["s"][s] < 2 and (c is None or c not in b["c"])]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": 32, "s": Counter(), "c": set()})
        bins[k]["room"] -= n
        bins[k]["s"][s] += 1
        bins[k]["c"].add(c)
        want[at] = k
    assert packing.best_fit(items, 32, 2) == want


PAGES = {
    None: "", "": "", "plain &amp; text": "plain & text", "<p>a<p>b": "a b", "<td": "", "text &am": "text &am", "x &lt;b&gt; <b>y</b>z": "x <b> yz",
    "<html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><a href=/>Home</a></nav><article><h1>H&eacute;</h1><p><b>one  two<br><p>three\n four</p></article><footer>f</footer></body></html>": "Hé one two three four",
    "<body><div id=page><div class='menu'><a href=x>A</a></div><div class=content><h2>T</h2><p>a<i>b</i>c d.</p><p>e</p></div><div class='comments'><p>long reader comment about all of it</p></div><form>q</form></div></body>": "T abc d. e",
    "<main><article><header><h1>T</h1></header><section><p>x y</p></section><aside>no</aside><section><p>z</p></section></article></main><footer>c</footer>": "T x y z",
    "<article><!-- no > --><p title='a>b'>yes</p><ul><li>i<li>j</ul><noscript>n</noscript></article>": "yes i j",
    "<div>" * 3000 + "deep" + "</div>" * 3000: "deep",
}


def test_pages(spark):
    rows = [(i, p, "x") for i, p in enumerate(PAGES)]
    got = spark.createDataFrame(rows, "page_id long, html string, text string").select("page_id", pages.extract(F.col("html")).alias("t")).collect()
    assert {r["page_id"]: r["t"] for r in got} == dict(enumerate(PAGES.values()))
    long = "<article>" + "".join(f"<p>word {i} &amp;</p>" for i in range(20_000)) + "</article>"
    assert pages.main_text(long) == " ".join(f"word {i} &" for i in range(20_000))


@pytest.mark.parametrize("page, want", [
    ("<article><div style='overflow:hidden'><p>first part</p></div><p title='hidden words'>second</p><p>see <a href=/hidden-x>this</a></p></article>", "first part second see this"),
    ("<article><p>shown part</p><p hidden>a</p><p HIDDEN=''>b</p><p aria-hidden=true>c</p><p data-role=menu>d</p></article>", "shown part d"),
    ("<div class='content with-sidebar'><p>the article of the page</p></div><div class=sidebar><p>beside</p></div>", "the article of the page"),
    ("<div class='post has-comments'><p>the text</p></div><div class=comments><p>a much longer comment by a reader</p></div>", "the text"),
    ("<div class='widget-text'><p>the article of the page</p><p>goes on</p></div>", "the article of the page goes on"),
    ("<article><div class=entry-header><h1>Title</h1></div><p>the article of the page</p></article>", "Title the article of the page"),
    ("<article><h1><a href=/x>Title</a></h1><div><p>some words</p><p>of the text</p></div><ul><li><a href=/y>source</a></ul></article>", "Title some words of the text source"),
])
def test_pages_keep_the_article(page, want):
    assert pages.main_text(f"<html><body>{page}</body></html>") == want


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    whole, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (whole - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mixing(spark):
    rows, docs = documents(spark)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(plain_words(t))
    want = plain_targets(sizes)
    got = mixing.copies(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, len(plain_words(t)), s) for i, t, s in rows)
    for source, n in sizes.items():
        own = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == n and math.isclose(r["target"], want[source]) and 0 <= r["copies"] <= 3 for r in own)
        assert abs(sum(r["copies"] for r in own) - len(own) * want[source] / max(1, n)) <= 1
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mixed(docs.limit(0)).count() == 0


def plain_near_copies(rows):
    """The (doc_id, text) rows that stay, by comparing all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        words = plain_words((text or "").lower())
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if group[i] != group[j] and 5 * both >= 4 * either:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    return {min((rows[i][0] is None, rows[i][0] or 0) for i in range(len(rows)) if group[i] == g) for g in group}


@pytest.mark.parametrize("hot", [1, 64])
def test_near_copies_against_all_pairs(spark, hot, monkeypatch):
    monkeypatch.setattr("acopio.llm.shingles.HOT", hot)
    rng = random.Random(12)
    rows = [(9000, None), (9001, ""), (9002, " \n"), (9003, "One two"), (9004, "one  two"), (9005, "one three")]
    boilerplate = [f"legal{i}" for i in range(30)]
    for base in range(30):
        words = boilerplate * (base % 2) + [f"b{base}w{rng.randrange(500)}" for _ in range(rng.choice([40, 100, 200]))]
        rows.append((base * 100, " ".join(words)))
        for k in range(1, 9):  # from equal to less than half alike
            changed = list(words)
            for at in rng.sample(range(len(changed)), min(len(changed), (k - 1) * len(changed) // 70 + (k > 1))):
                changed[at] = f"new{rng.randrange(10**6)}"
            rows.append((base * 100 + k, " ".join(changed)))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    want = plain_near_copies(rows)
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert len(got) == len(set(got)) and {(False, i) for i in got} == want and 31 < len(want) < len(rows) - 40


def test_pipeline_stages(spark, tmp_path):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    docs = base.withColumn("row", F.lit(1)).withColumn("score", F.lit("s")).withColumn("at", F.lit(2)).withColumn("n_words", F.lit(0))
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).select(*(F.lit(None).cast(t).alias(c) for c, t in docs.dtypes)))
    for i, (_, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs
        docs = step(spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == before.columns
        if i < 3:
            assert docs.exceptAll(before).isEmpty()
        empty = step(spark, before.limit(0), SF)
        assert empty.count() == 0 and empty.columns == before.columns
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF).count() > 0
