"""Conversation trie, chat formatting and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acopio.llm import banding, chat, licenses, pages, queries, shingles, simhash, spelling, trie

TURNS = "conv_id long, turn long, role string, text string, tokens string, shard string"


def conversations(rng, n, most=9):
    """Turns with shared beginnings, copies, nulls, ties and repeats, in no order."""
    rows = []
    pool = [("user", "a"), ("assistant", "b"), ("user", "ab"), ("usera", "b"), (None, None), ("assistant", ""), ("system", "Be brief. é😀"), ("user", "x" * 3000)]
    for c in rng.sample(range(-300, 900), n):
        path = [rng.choice(pool[: rng.choice([1, 2, 8])]) for _ in range(rng.randint(1, most))]
        rows += [(c, None if i == 0 and rng.random() < 0.3 else i, *said) for i, said in enumerate(path)]
    rows += [(5000 + i, t, "user", "same") for i in range(40) for t in range(4)]
    rows += [(7000, 3, "user", "tie"), (7000, 3, "user", "tie"), (7000, 3, "user", "eit"), (None, 1, "user", "nobody")]
    rows += [(7100 + 100 * i, t, "user", f"long {t % 3}") for i in range(3) for t in range(700)]
    rng.shuffle(rows)
    return rows


def plain_digest(role, text):
    return hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", plain_digest(role, text), text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(lead, [])[:h] + said[h:]
    return out


def plain_trie(rebuilt):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        path = tuple(rebuilt[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        cost = (len(own) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += not children[p]
    return Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


@pytest.mark.parametrize("shard", [(1024, 256), (8, 4)])
def test_trie(spark, monkeypatch, shard):
    monkeypatch.setattr(trie, "CONVERSATIONS", shard[0])
    monkeypatch.setattr(trie, "POSITIONS", shard[1])
    rows = conversations(random.Random(sum(shard)), 120)
    df = spark.createDataFrame([(*r, "t", "s") for r in rows], TURNS)
    got = trie.prefix_trie(*queries.rebuilt_conversations(df))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == plain_trie(plain_rebuilt(rows))


def test_trie_of_silent_or_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, depth long, tokens long, digest string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "conv_id long")
    assert trie.prefix_trie(ids(), turns).count() == 0
    (root,) = trie.prefix_trie(ids(3, 1, None, 3), turns).collect()
    assert tuple(root) == (1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,3").hexdigest())
    empty = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(*queries.rebuilt_conversations(empty)).count() == 0


EVENTS = "conv_id long, message long, seq long, kind string, role string, text string, number string, place int"


def test_fold(spark):
    rows = [
        (1, 1, 1, "start", "user", None), (1, 1, 2, "delta", None, "He"), (1, 1, 3, "delta", None, "llo"),
        (1, 2, 1, "start", "assistant", "old"), (1, 2, 2, "delta", None, " text"), (1, 2, 3, "edit", None, "new"), (1, 2, 4, "delta", None, "!"),
        (1, 3, 1, "start", "assistant", None), (1, 3, 2, "delta", None, "wrong"), (1, 3, 3, "regenerate", None, None), (1, 3, 5, "delta", None, "t"), (1, 3, 4, "delta", None, "righ"),
        (1, 4, 1, "edit", "user", "a"), (1, 4, 2, "edit", "tool", "b"), (1, 4, 3, None, None, None),
        (2, 1, 1, "delta", None, "x"), (2, 1, 1, "delta", None, "x"), (2, None, None, "delta", "u", "n"), (None, 1, 1, "start", "user", "who"),
        (3, 1, 9, "start", None, None),
    ]
    random.Random(3).shuffle(rows)
    got = chat.fold(spark.createDataFrame([(*r, "n", 1) for r in rows], EVENTS)).collect()
    assert Counter(tuple(r) for r in got) == Counter([
        (1, 1, "user", "Hello"), (1, 2, "assistant", "new!"), (1, 3, "assistant", "right"), (1, 4, "tool", "b"),
        (2, 1, "", "xx"), (2, None, "u", "n"), (None, 1, "user", "who"), (3, 1, "", ""),
    ])
    assert chat.fold(spark.createDataFrame([], EVENTS)).count() == 0


PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/", "s>", "[", "INST]", "$1", "\n", "é", "😀", " ", "a", "<\\s>", "[\\/INST]", "\0"]


def test_escapes_are_reversible(spark):
    rng = random.Random(8)
    texts = ["", *PIECES, *("".join(rng.choice(PIECES) for _ in range(rng.randint(1, 12))) for _ in range(3000))]
    for text, escaped, back in spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")), chat.unescape(chat.escape(F.col("t")))).collect():
        assert back == text and not re.search(r"</?s>|\[/?INST\]", escaped)


def test_render_and_read_back(spark):
    rng = random.Random(9)
    rows = []
    for c in [*range(60), None]:
        for m in rng.sample([None, *range(12)], rng.randint(1, 12)):
            rows.append((c, m, rng.choice(["user", "assistant", "assistant", "sys]\n[INST]", None, ""]), rng.choice([None, "", "".join(rng.choice(PIECES) for _ in range(9))])))
    rows += [(99, 1, "user", "tie"), (99, 1, "user", "tie"), (99, 1, "assistant", "z"), (100, 1, "assistant", "word \\ " * 100_000)]
    want = defaultdict(list)
    for c, m, role, text in rows:
        want[c].append((m is not None, m or 0, role or "", text or ""))
    want = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in want.items()}
    df = spark.createDataFrame([(*r, "x", [1]) for r in rows], "conv_id long, message long, role string, text string, head string, parts array<int>")
    done = chat.render(df)
    got = done.select("conv_id", "formatted", "loss", chat.turns_of(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == want
    for r in got:
        assert r["learned"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
        assert r["formatted"].startswith(chat.BOS) and r["formatted"].count(chat.EOS) == r["formatted"].count(chat.OPEN) == len(want[r["conv_id"]])
        assert len(r["loss"]) == sum(role == "assistant" for role, _ in want[r["conv_id"]])
    assert chat.render(df.limit(0)).count() == 0


def test_formatting_has_no_python_worker(spark):
    plan = queries.op12_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|ExistingRDD", plan)


def plain_variants(words, ratio=5):
    near = {w: set() for w in words}
    for w in words:
        for v in words:
            if v != w and abs(len(v) - len(w)) <= 1:
                if len(v) == len(w):
                    linked = sum(a != b for a, b in zip(v, w)) == 1
                else:
                    long, short = (v, w) if len(v) > len(w) else (w, v)
                    linked = any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
                if linked:
                    near[w].add(v)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return Counter((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants(spark, seed):
    rng = random.Random(seed)
    words = {}
    while len(words) < 400:
        base = "".join(rng.choice("abÿ") for _ in range(rng.randint(1, 11)))
        words[base] = rng.choice([1, 2, 5, 10, 25, 125, 625, 3125])
    long = "".join(rng.choice("abcdefghé") for _ in range(3000))
    words |= {long: 100, long[:1500] + long[1501:]: 2, long[:-1] + "z": 10, long + "a": 20, "": 3}
    df = spark.createDataFrame([(w, n, 1, "p") for w, n in words.items()] + [(None, 5, 1, "p"), ("nothing", None, 1, "p")], "word string, n int, id int, p string")
    got = spelling.variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(tuple(r) for r in got.collect()) == plain_variants(words)
    assert spelling.variants(df.limit(0)).count() == 0


def test_slipped_words(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("ABcdéÀÿ×") for _ in range(rng.choice([1, 5, 6, 7, 12]))) for _ in range(30)]
    docs = [(None if i == 7 else i % 300, rng.choice([" ", "1", "\n", "Ā"]).join(rng.choice(vocabulary) for _ in range(60)) if i % 20 else None) for i in range(400)]
    docs += [(1, ""), (2, "wordword " * 30_000)]
    want = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 6
    df = spark.createDataFrame([(*d, "x", 0) for d in docs], "doc_id long, text string, run string, n int")
    assert {tuple(r) for r in queries.slipped_words(df).collect()} == {(w, n) for w, n in want.items() if n >= 5}


def test_spelling_query(spark):
    sf = "/root/testdata/sf0.001"
    counted = {r["word"]: r["n"] for r in queries.slipped_words(queries.table(spark, sf, "documents")).collect()}
    assert Counter(tuple(r) for r in queries.op13_spelling_variants(spark, sf).collect()) == plain_variants(counted)


def test_class_words_inside_an_article():
    page = """<body><nav>menu</nav><article><h1>Title</h1><p class="byline">By Ann Author</p><p>{}</p><p class="tags">about birds</p>
    <p class="social-policy">The policy.</p><p id="notice-of-intent">The intent.</p><div class="ad-slot">Buy now</div><div class="social links">Share it</div>
    <div class="comment-list"><p>first!</p></div></article><div class="related-articles">Other news</div></body>"""
    text = pages.main_text(page.format("Words of the story. " * 40))
    for kept in ("By Ann Author", "about birds", "The policy.", "The intent.", "Title"):
        assert kept in text
    for gone in ("Buy now", "Share it", "first!", "menu", "Other news"):
        assert gone not in text


def test_a_crowd_within_one_batch():
    rng = np.random.default_rng(5)
    fps = np.sort(rng.integers(-(2**62), 2**62, 9000))
    key = np.r_[np.full(9000, 7), [9, 9]]
    out = pd.concat(simhash._meet(3, 2048)(iter([pd.DataFrame({"key": key, "fp": np.r_[fps, [4, 5]]}), pd.DataFrame({"key": [10], "fp": [1]})])))
    assert set(out[out.crowded].a) == set(fps) and [tuple(r) for r in out[~out.crowded][["a", "b"]].to_numpy()] == [(4, 5)]


def test_banded_keys_find_four_fifths():
    """Recall of the keys alone, over pairs of known similarity."""
    rng = np.random.default_rng(2)
    found = {s: 0 for s in (0.8, 0.85, 0.9)}
    for s in found:
        for _ in range(300):
            n = int(rng.choice([10, 60, 400]))
            both = max(1, round(2 * n * s / (1 + s)))
            a, b = (np.unique(rng.integers(0, 2**63, n - both, np.uint64)) for _ in range(2))
            common = rng.integers(0, 2**63, both, np.uint64)
            found[s] += not set(banding.bands_of(np.r_[a, common])).isdisjoint(banding.bands_of(np.r_[b, common]))
    assert all(n >= 297 for n in found.values())
    assert banding.bands_of(np.empty(0, np.uint64)) == []


@pytest.mark.parametrize("crowd", [16, 32])
def test_banded_copies_against_all_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(banding, "CROWD", crowd)
    monkeypatch.setattr(banding, "PER_CENTRE", 3)
    rng = random.Random(7)
    texts = []
    for base in range(25):
        words = [f"s{i}" for i in range(40)] * (base % 2) + [f"b{base}w{rng.randrange(300)}" for _ in range(rng.choice([30, 90]))]
        for k in range(8):
            changed = list(words)
            for at in rng.sample(range(len(changed)), k * len(changed) // 80):
                changed[at] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(changed))
    texts = list(dict.fromkeys(texts))
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string").select("node", "text", banding.marks(F.col("text")).alias("m"))
    rows = rows.dropDuplicates(["node"]).cache()
    got = {r["node"]: r["component"] for r in banding.near_copies(rows.select("node", "m.n", "m.bits", "m.bands"), rows.select("node", "text")).collect()}
    sets = [set(shingles.shingles(t).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    want = Counter(group)
    assert {i for i, g in enumerate(group) if want[g] > 1} == set(got)
    assert len({got[i] for i in got}) == sum(n > 1 for n in want.values())
    assert all((got[i] == got[j]) == (group[i] == group[j]) for i in got for j in got)


@pytest.mark.parametrize(
    "text, names",
    [
        ("Copyright (c) 2020 X. All rights reserved.\n\nLicensed under the BSD 3-Clause License.", ["BSD"]),
        ("Copyright (c) 2020 X. All rights reserved.", ["Proprietary"]),
        ("All rights reserved. Proprietary and confidential.", ["Proprietary"]),
        ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
        ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
        ("SPDX-License-Identifier: GPL-3.0-or-later\n", ["GPL-3.0-or-later"]),
        ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\n"
         "version 2.1 of the License, or (at your option) any later version.", None),
        ("Licensed under the GNU Lesser General Public License version 2.1.", ["LGPL-2.1-only"]),
        ("This work is licensed under the GNU Lesser General Public License version 3.", ["LGPL-3.0-only"]),
    ],
)
def test_licence_notices(spark, text, names):
    got = licenses.licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    if names is not None:
        assert [r["licences"] for r in got] == [names]
    else:
        assert got[0]["licences"] == ["LGPL-2.1-or-later"]
