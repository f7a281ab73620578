import random

import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from acopio.llm import simhash
from acopio.llm.components import connected_components


def plain_simhash(text):
    """Bit by bit, from the definition."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return "0" * 16
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)):016x}"


def components_of(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                parent[root(a)] = root(b)
    groups = {}
    for n in nodes:
        groups.setdefault(root(n), set()).add(n)
    return {n: frozenset(g) for g in groups.values() for n in g}


def near(a, b, radius=3):
    return bin((a ^ b) & (2**64 - 1)).count("1") <= radius


def clustered(n, seed):
    rng = random.Random(seed)
    found = set()
    while len(found) < n:
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 6])):
            found.add(at - (1 << 64) if at >> 63 else at)
            for _ in range(rng.choice([1, 2, 3, 3, 4, 5])):
                at ^= 1 << rng.randrange(64)
    return sorted(found)


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "two words", "a B c d", "é É a b c d\x0be f"] + ["w%d " % i * (i % 3 + 1) + "x y z" * i for i in range(20)])
def test_fingerprint_by_definition(text):
    assert f"{simhash.simhash(text) & (2**64 - 1):016x}" == plain_simhash(text)


def test_long_text_is_counted_in_parts():
    text = " ".join(str(i * i % 977) for i in range(70_000))
    assert f"{simhash.simhash(text) & (2**64 - 1):016x}" == plain_simhash(text)


@pytest.mark.parametrize("radius, crowd", [(3, 2048), (3, 1), (3, 2), (2, 2048), (2, 1), (1, 2048)])
def test_links_join_exactly_what_is_near(spark, radius, crowd):
    fps = clustered(70, radius)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius, crowd)
    got = {r[0]: r[1] for r in connected_components(edges).collect()}
    want = components_of(fps, lambda a, b: near(a, b, radius))
    for f in fps:
        assert got.get(f, f) == min(want[f])


def test_every_pair_of_bits_blocks_is_found(spark):
    rng = random.Random(9)
    pairs = []
    for bits in ([0], [63], [5, 6, 7], [0, 30, 60], [21, 22, 43], [40, 41, 63], [1, 2, 50]):
        at = rng.getrandbits(62)
        pairs.append((at, at ^ sum(1 << b for b in bits)))
    fps = [(f - (1 << 64) if f >> 63 else f,) for p in pairs for f in p]
    got = connected_components(simhash.links(spark.createDataFrame(fps, "fp long"))).collect()
    assert len({r[1] for r in got}) == len(pairs) and len(got) == 2 * len(pairs)


def test_crowded_variant_over_several_batches():
    key, fps = 7, list(range(1, 12))
    batches = [pd.DataFrame({"key": [5, key, key], "fp": [1, 1, 2]}), pd.DataFrame({"key": [key] * 9, "fp": fps[2:]}), pd.DataFrame({"key": [9, 9], "fp": [4, 5]})]
    out = pd.concat(simhash._meet(3, 4)(iter(batches)))
    assert set(out[out.crowded].a) == set(fps)
    assert [tuple(r) for r in out[~out.crowded][["a", "b"]].to_numpy()] == [(4, 5)]


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(7, base), (3, base), (9, base + " more"), (1, None), (2, ""), (None, base), (5, "quite another text of words"), (5, "quite another text of words")]
    prints = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", simhash.fingerprint(F.col("text")).alias("fp"), F.lit("x").alias("component_id"))
    got = {(r["doc_id"], r["component_id"], r["component_rows"]) for r in simhash.near_duplicates(prints).collect()}
    want = {}
    marks = [(i, int(plain_simhash(t), 16)) for i, (_, t) in enumerate(rows)]
    groups = components_of(marks, lambda a, b: near(a[1], b[1]))
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j, _ in groups[marks[i]]]
        want[i] = (doc_id, min(x for x in ids if x is not None), len(ids))
    assert got == set(want.values())
    assert simhash.near_duplicates(prints.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 5), (None, 3), (8, 4), (4, 8), (9, 4)]])
def test_components(spark, edges):
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {frozenset(e) for e in edges if None not in e and e[0] != e[1]}
    nodes = {n for p in pairs for n in p}
    want = components_of(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert got == {n: min(want[n]) for n in nodes}
