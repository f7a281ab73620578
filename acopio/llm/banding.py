"""Near copies by banded MinHash keys of word shingles, verified on the shingles themselves.

A text has 100 minima of its set of five-word shingles, in 20 bands of five. Two texts of
similarity s share a band with probability 1 - (1 - s^5)^20: 0.9996 at 0.8, the least that
counts. What shares a band is compared in steps that each leave less to do:

1. every text with the centre it shares most bands with;
2. where that left them in different components, with its other centres, and the members of
   a band of up to ``CROWD`` with each other;
3. members of larger bands by their rarest shingles: near copies share one of those, and both
   have enough shingles after the first they share. Each is compared with the few that look
   most like it, and then with all that this still leaves apart.

Texts that share a long passage without being near copies crowd a band. Comparing all of them
would grow with the square of the crowd; their rarest shingles are those outside the passage,
and so meet few others. No pair of a band is left out.

A pair is never taken for alike by its keys: sketches rule most of the others out without
error, and what they leave is compared on whole texts, one of which is shuffled per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from acopio.llm import shingles
from acopio.llm.components import connected_components
from acopio.llm.shingles import DENOMINATOR, NUMERATOR, alike, sketch
from acopio.llm.shingles import shingles as shingles_of
from acopio.session import stage

BANDS, ROWS = 20, 5
#: Members that one task compares with their centre.
PER_CENTRE = 4096
#: Members of a band that are compared with each other; those of a larger one are if they share a rare shingle.
CROWD = 32
#: Members of a crowd that hold a shingle and are met by one task with as many others; those that each is compared with first.
PER_MEETING, PICKS = 512, 4

_RANDOM = np.random.default_rng(20)
_FACTORS = (_RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64) << np.uint64(1)) | np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64)
_CHUNK = 1024

_MARKS = StructType([StructField("key", StringType()), StructField("n", LongType()), StructField("bits", BinaryType()), StructField("bands", ArrayType(LongType()))])


def minima(own: np.ndarray) -> np.ndarray:
    """The least value of each of the random functions over a set of hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(own), _CHUNK):
        part = own[start : start + _CHUNK]
        np.minimum(least, ((_FACTORS[:, None] * part + _OFFSETS[:, None]) >> np.uint64(32)).min(axis=1), out=least)
    return least


def bands_of(own: np.ndarray) -> list[int]:
    if not len(own):
        return []
    values = minima(own).reshape(BANDS, ROWS)
    return [int(np.uint64(xxhash.xxh64_intdigest(row.tobytes(), i)).astype(np.int64)) for i, row in enumerate(values)]


@F.pandas_udf(_MARKS)
def _marks(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        out = []
        for text in batch:
            own = shingles_of(text)
            out.append((hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest(), len(own), sketch(own), bands_of(own)))
        yield pd.DataFrame(out, columns=["key", "n", "bits", "bands"])


def marks(text: Column) -> Column:
    """(key, n, bits, bands) of a text: ``key`` is the same for texts of the same set of shingles."""
    return _marks(text)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows of a centre, the centre's own text first: the members that are near copies of it."""
    centre, own = None, None
    for batch in batches:
        found = []
        for a, b, text in zip(batch["a"], batch["b"], batch["text"]):
            if a == b:
                centre, own = a, shingles_of(text)
            elif a == centre and alike(own, shingles_of(text)):
                found.append((a, b))
        yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Of distinct pairs (a, b) those that are near copies."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    may = stage(sized.where(_close("n_a", "n_b")).where(shingles._may_be_alike("n_a", "n_b", "bits_a", "bits_b")).select("a", "b"), "candidates")
    # a centre of very many members is split, and its text goes to each part
    parts = F.ceil(F.col("members") / PER_CENTRE).cast("int")
    sizes = may.groupBy("a").agg(F.count(F.lit(1)).alias("members")).select("a", parts.alias("parts"))
    members = may.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    own = sizes.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    sent = members.unionByName(own).join(texts.withColumnRenamed("node", "b"), "b")
    grouped = sent.repartition("a", "part").sortWithinPartitions("a", "part", F.col("a") != F.col("b"))
    return grouped.select("a", "b", "text").mapInPandas(_compare, "a long, b long")


def _close(x: str, y: str) -> Column:
    least, most = F.least(x, y), F.greatest(x, y)
    return NUMERATOR * most <= DENOMINATOR * least


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    where = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"at_{c}"))
    placed = pairs.join(where("a"), "a", "left").join(where("b"), "b", "left")
    return placed.where(F.coalesce("at_a", "a") != F.coalesce("at_b", "b")).select("a", "b")


def near_copies(sets: DataFrame, texts: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """(node, component) of the texts that are a near copy of another, directly or by others.

    ``sets`` (node, n, bits, bands: see ``marks``) is a written table of distinct long nodes, no
    two with the same set of shingles; ``texts`` (node, text) is one with those nodes, and may
    have others. ``linked`` (a, b) is a written table of nodes known to be near copies, which
    are not compared again.
    """
    member = sets.select("node", "n", F.explode("bands").alias("band"))
    centres = member.groupBy("band").agg(F.min(F.struct("n", "node")).alias("least"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    met = member.join(centres, "band").select("band", "node", "n", "sets", F.col("least.node").alias("centre"), F.col("least.n").alias("centre_n"))
    shared = stage(met, "shared")
    stars = shared.where("node <> centre").where(_close("n", "centre_n")).groupBy(F.col("centre").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("bands"))
    stars = stage(stars, "stars")
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("bands", "a")).alias("a")).select("a", "b")
    if linked is None:
        edges = _verified(best, sets, texts)
    else:
        known = stage(connected_components(linked), "known")
        edges = _ties(known).unionByName(_verified(_apart(best, known), sets, texts))
    found = stage(connected_components(edges), "components")
    others = stars.select("a", "b").join(best, ["a", "b"], "left_anti")
    either = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    placed = stage(_split_bands(shared, found), "split-bands")
    crowds = _crowds(placed, sets, texts)
    few = _few(placed) if crowds is None else _few(placed).unionByName(_picked(crowds, found)).distinct()
    left = stage(_apart(others, found).unionByName(few.join(either, ["a", "b"], "left_anti")), "left-pairs")
    more = stage(_verified(left, sets, texts), "more-edges")
    if not more.isEmpty():
        found = connected_components(_ties(found).unionByName(more))
    if crowds is None:
        return found
    found = stage(found, "components")
    done = either.unionByName(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    rest = stage(_met(crowds, found, False).select("a", "b").distinct().join(done, ["a", "b"], "left_anti"), "crowd-pairs")
    more = stage(_verified(rest, sets, texts), "crowd-edges")
    return found if more.isEmpty() else connected_components(_ties(found).unionByName(more))


def _ties(found: DataFrame) -> DataFrame:
    """Edges of the same components, each node tied to its component: one round finds them again."""
    return found.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")


def _few(placed: DataFrame) -> DataFrame:
    """Pairs of members that are apart, of bands with few members."""
    placed = placed.where(F.col("sets") <= CROWD)
    x, y = placed.alias("x"), placed.alias("y")
    met = (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
    return x.join(y, met).where(_close("x.n", "y.n")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _split_bands(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the bands whose members are in different components."""
    placed = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    return placed.select("band", "node", "n", "sets", "component").join(split, "band")


@F.pandas_udf(ArrayType(LongType()))
def _tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([shingles_of(t).view(np.int64) for t in batch], dtype="object")


def _crowds(placed: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(token, node, n, pos, members, bits): the rarest shingles of the members of large bands, with their place in the order; None if there are none.

    Shingles are ordered by the number of members that hold them. Alike sets of n and m shingles have
    4 (n + m) / 9 or more in common and none before the first of them, so both have so many from there on.
    """
    nodes = stage(placed.where(F.col("sets") > CROWD).select("node").distinct(), "crowd-nodes")
    if nodes.isEmpty():
        return None
    held = stage(texts.join(nodes, "node", "left_semi").select("node", F.explode(_tokens("text")).alias("token")), "crowd-shingles")
    counted = held.join(held.groupBy("token").agg(F.count(F.lit(1)).alias("holders")), "token")
    ranked = counted.withColumn("pos", F.row_number().over(Window.partitionBy("node").orderBy("holders", "token")) - 1)
    first = ranked.where("holders > 1").select("token", "node", "pos").join(sets.select("node", "n", "bits"), "node")
    first = first.where(DENOMINATOR * (F.col("n") - F.col("pos")) >= NUMERATOR * F.col("n"))
    return stage(first.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("members > 1"), "crowd-prefixes")


def _met(crowds: DataFrame, found: DataFrame, nearest: bool) -> DataFrame:
    """(a, b, differ) of members of crowds that are apart and may be alike, or for each member of a meeting that pair which differs least.

    Members that hold the same shingle are dealt over parts and each two parts are a meeting, so that no task holds a crowd.
    """
    parts = F.ceil(F.col("members") / PER_MEETING).cast("int")
    placed = crowds.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    placed = placed.select("token", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "n", "pos", "component", "bits")
    meetings = placed.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "n", "node")
    return meetings.mapInPandas(_meetings(nearest), "a long, b long, differ double")


def _picked(crowds: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of each member of a crowd with a few of those that look most like it."""
    least = F.slice(F.array_sort(F.collect_set(F.struct("differ", "b"))), 1, PICKS)
    picked = _met(crowds, found, True).groupBy("a").agg(least.alias("picks"))
    return picked.select("a", F.explode("picks.b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _meetings(nearest: bool):
    """Over the rows of meetings, the smaller sets first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = None
        for batch in batches:
            rows = batch if rows is None else pd.concat([rows, batch], ignore_index=True)
            if len(rows):
                key = rows[["token", "low", "high"]].to_numpy()
                starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
                yield _pairs(rows, starts, nearest)
                # the last meeting may go on in the next batch
                rows = rows.iloc[starts[-1] :]
        if rows is not None:
            yield _pairs(rows, np.array([0, len(rows)]), nearest)

    return run


def _pairs(rows: pd.DataFrame, starts: np.ndarray, nearest: bool) -> pd.DataFrame:
    columns = [rows[c].to_numpy() for c in ("node", "n", "pos", "component", "low", "high", "part", "bits")]
    found = [p for i, j in zip(starts[:-1], starts[1:]) if j - i > 1 for p in _meeting(*(c[i:j] for c in columns), nearest)]
    return pd.DataFrame(found, columns=["a", "b", "differ"]).astype({"a": "int64", "b": "int64", "differ": "float64"}).drop_duplicates()


def _meeting(node, n, pos, component, low, high, part, bits, nearest: bool) -> Iterator[tuple[int, int, float]]:
    more, both = NUMERATOR, NUMERATOR + DENOMINATOR
    lengths = np.array([len(x) for x in bits])
    sketches, at = {}, np.zeros(len(node), np.int64)
    for length in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == length)
        sketches[length], at[same] = np.frombuffer(b"".join(bits[same]), np.uint8).reshape(-1, length), np.arange(len(same))
    rest = both * (n - pos)
    for i in range(len(node) - 1):
        total = n[i] + n[i + 1 :]
        ok = (component[i + 1 :] != component[i]) & (rest[i] >= more * total) & (rest[i + 1 :] >= more * total)
        if low[0] != high[0]:
            ok &= part[i + 1 :] != part[i]  # those of the same part have a meeting of their own
        others, found = np.flatnonzero(ok) + i + 1, []
        for length in np.unique(lengths[others]).tolist():
            these = others[lengths[others] == length]
            few = min(length, int(lengths[i]))
            own = np.bitwise_xor.reduce(sketches[int(lengths[i])][at[i]].reshape(-1, few), axis=0)
            folded = np.bitwise_xor.reduce(sketches[length][at[these]].reshape(len(these), -1, few), axis=1)
            differ, total = np.bitwise_count(folded ^ own).sum(axis=1, dtype=np.int64), n[i] + n[these]
            may = np.flatnonzero(both * differ <= (DENOMINATOR - more) * total)
            found += zip((differ[may] / total[may]).tolist(), node[these[may]].tolist())
        yield from ((int(node[i]), b, d) for d, b in ([min(found)] if nearest and found else found))
