"""Near copies by the similarity of their word shingles, found by an exact set join.

Two texts are near copies if the sets of their shingles have a Jaccard similarity of 4/5 or
more. In any fixed order of all shingles such a pair shares one among the first
``n - ceil(4n/5) + 1`` of each side, so only these are compared (prefix filtering), and every
pair found that its sketches don't rule out is verified on the whole texts: no pair is missed and none is added. The order is
that of the shingles' hashes, but shingles found hot are put last, where few prefixes hold them.

Only distinct sets are compared. Members of a shingle are first tied to one centre and
verified; only pairs that this leaves in different components are compared with each other,
so that a crowd of real copies costs no pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from acopio.llm.components import connected_components
from acopio.session import stage

SHINGLE = 5
#: The least similarity, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
#: Sets that hold a shingle among their first before it is hot, and the most shingles so marked (the largest).
HOT, MOST_HOT = 64, 100_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``shingle``-word runs; a shorter text is one run, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(42)), np.uint64))


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1 if n else 0


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


@F.pandas_udf(StringType())
def _set_keys(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([hashlib.blake2b(shingles(t).tobytes(), digest_size=16).hexdigest() for t in batch], dtype="object")


def set_key(text: Column) -> Column:
    """The same for texts of the same set of shingles."""
    return _set_keys(text)


def _prefixes(hot: list[int]) -> Column:
    last = np.sort(np.array(hot, np.int64).view(np.uint64))

    def cut(text: str | None):
        own = shingles(text)
        late = np.isin(own, last)
        return len(own), np.r_[own[~late], own[late]][: prefix_length(len(own))].view(np.int64)

    @F.pandas_udf(StructType([StructField("n", LongType()), StructField("first", ArrayType(LongType()))]))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([cut(t) for t in batch], columns=["n", "first"])

    return run


@F.pandas_udf(BooleanType())
def _alike(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([alike(shingles(x), shingles(y)) for x, y in zip(a, b)], dtype="bool")


def sketch(own: np.ndarray) -> bytes:
    """Parities of the numbers of shingles that fall on each of some bits; two to four times as many bits as shingles."""
    size = 1 << max(9, len(own).bit_length() + 1)
    return np.packbits(np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8).tobytes()


def may_be_alike(n: int, m: int, a: bytes, b: bytes) -> bool:
    """False only for sets of n and m shingles that are not alike: sketches differ in no more bits than sets in shingles."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    least = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, least), axis=0) for z in (x, y))
    differ = int(np.bitwise_count(x ^ y).sum())
    return (DENOMINATOR + NUMERATOR) * differ <= (DENOMINATOR - NUMERATOR) * (n + m)


@F.pandas_udf(StructType([StructField("n", LongType()), StructField("bits", BinaryType())]))
def _sketches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([(len(own), sketch(own)) for own in map(shingles, batch)], columns=["n", "bits"])


@F.pandas_udf(BooleanType())
def _may_be_alike(pairs: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for four in pairs:
        yield pd.Series([may_be_alike(*x) for x in zip(*four)], dtype="bool")


def _verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those that are near copies; texts are fetched for those only whose sketches allow it."""
    small = [sketches.select(F.col("node").alias(c), F.col("s.n").alias(f"n_{c}"), F.col("s.bits").alias(f"bits_{c}")) for c in "ab"]
    pairs = pairs.join(small[0], "a").join(small[1], "b").where(_may_be_alike("n_a", "n_b", "bits_a", "bits_b")).select("a", "b")
    pairs = stage(pairs, "candidates")
    sides = [texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    return both.where(_alike("text_a", "text_b")).select("a", "b")


def near_copies(texts: DataFrame) -> DataFrame:
    """(node, component) of the texts that are a near copy of another, directly or by others.

    ``texts`` is a written table of a distinct long ``node`` and ``text``, no two with the
    same set of shingles.
    """
    hot: list[int] = []
    sketches = stage(texts.select("node", _sketches("text").alias("s")), "sketches")
    cut = stage(texts.select("node", _prefixes(hot)("text").alias("p")).select("node", "p.n", F.explode("p.first").alias("token")), "prefixes")
    counted = cut.groupBy("token").count().where(F.col("count") > HOT).orderBy(F.col("count").desc(), "token").limit(MOST_HOT)
    hot = [r["token"] for r in counted.collect()]
    if hot:
        cut = texts.select("node", _prefixes(hot)("text").alias("p")).select("node", "p.n", F.explode("p.first").alias("token"))
    # a shingle of one set makes no pair
    centres = cut.groupBy("token").agg(F.min(F.struct("n", "node")).alias("least"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = stage(cut.join(centres, "token").select("token", "node", "n", F.col("least.node").alias("centre"), F.col("least.n").alias("centre_n")), "shared")
    close = lambda x, y: NUMERATOR * F.greatest(x, y) <= DENOMINATOR * F.least(x, y)
    stars = shared.where("node <> centre").where(close(F.col("n"), F.col("centre_n")))
    stars = stage(stars.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct(), "stars")
    edges = stage(_verified(stars, texts, sketches), "edges")
    found = stage(connected_components(edges), "components")
    # what is left: pairs of one shingle that are in different components
    member = shared.select("token", "node", "n").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = member.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    member = stage(member.join(apart, "token"), "members")
    x, y = member.alias("x"), member.alias("y")
    rest = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")) & close(F.col("x.n"), F.col("y.n")))
    rest = rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    more = stage(_verified(rest, texts, sketches), "more-edges")
    return found if more.isEmpty() else connected_components(edges.unionByName(more))
