"""Near copies in bands of many members."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from acopio.llm import banding, shingles


def _texts():
    """Chains of copies that crowd their bands, most alike to a few others only, and texts that share a passage without being copies."""
    rng = random.Random(3)
    texts = []
    for base in range(4):
        chain = [[f"b{base}w{i}" for i in range(120)]]
        for _ in range(30):
            changed = list(rng.choice(chain[-6:]))
            for at in rng.sample(range(60), rng.choice([1, 2, 2, 3])):
                changed[at] = f"new{rng.randrange(10**6)}"
            chain.append(changed)
        texts += map(" ".join, rng.sample(chain, len(chain)))
    passage = [f"p{i}" for i in range(100)]
    texts += [" ".join([*passage, *(f"own{k}x{i}" for i in range(16))]) for k in range(40)]
    return list(dict.fromkeys(texts))


def _components(texts):
    sets = [set(shingles.shingles(t).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    return group


@pytest.mark.parametrize("picks, per_meeting", [(4, 512), (1, 5)])
def test_no_pair_of_a_crowded_band_is_left_out(spark, monkeypatch, picks, per_meeting):
    for name, value in {"CROWD": 2, "PICKS": picks, "PER_MEETING": per_meeting}.items():
        monkeypatch.setattr(banding, name, value)
    texts = _texts()
    group = _components(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string").select("node", "text", banding.marks(F.col("text")).alias("m")).cache()
    found = {r["node"]: r["component"] for r in banding.near_copies(rows.select("node", "m.n", "m.bits", "m.bands"), rows.select("node", "text")).collect()}
    got = [found.get(i, i) for i in range(len(texts))]
    assert 44 < len(set(group)) < len(texts) - 60
    assert all((got[i] == got[j]) == (group[i] == group[j]) for i in range(len(texts)) for j in range(i))


def test_a_meeting_over_several_batches():
    """Pairs do not depend on how the rows of a meeting come; sketches of two lengths are compared."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(266)]
    rows = []
    for node in range(12):
        changed = list(words[: 254 + node])
        for at in rng.sample(range(250), node % 4):
            changed[at] = f"new{node}x{at}"
        own = shingles.shingles(" ".join(changed))
        rows.append((7 + node // 8, 0, 0, 0, node, len(own), 0, node, shingles.sketch(own)))
    frame = pd.DataFrame(rows, columns=["token", "low", "high", "part", "node", "n", "pos", "component", "bits"])
    assert frame["bits"].map(len).nunique() == 2
    want = {(a, b) for a in range(12) for b in range(a + 1, 12) if a // 8 == b // 8 and shingles.may_be_alike(*frame["n"][[a, b]], *frame["bits"][[a, b]])}
    for size in (1, 5, 12):
        batches = [frame.iloc[at : at + size] for at in range(0, 12, size)]
        out = pd.concat(banding._meetings(False)(iter([frame.iloc[:0], *batches])))
        assert set(zip(out["a"], out["b"])) == want and len(want) > 20
        least = pd.concat(banding._meetings(True)(iter(batches)))
        assert set(zip(least["a"], least["b"])) <= want and least["a"].is_unique
