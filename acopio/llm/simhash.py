"""Near-duplicate documents by SimHash fingerprints and ball hashing.

Meet in the middle: two fingerprints differ in at most ``radius`` bits exactly if their
balls of half the radius meet. Half of an odd radius is not whole, and balls of the next
whole radius (2,081 variants for radius 3) move fifteen times as many rows. So for an odd
radius the bits are cut in three blocks and each block is left out in turn: a pair that
differs somewhere differs in some block, and leaving that one out leaves at most
``radius - 1`` differing bits, so balls of half of that meet. Radius 3 takes 131 variants
and finds every pair. Colliding pairs are verified on all bits.

Only distinct fingerprints are compared. A variant shared by more fingerprints than
``crowd`` is not compared pairwise: its fingerprints go to a second round with balls of
``radius // 2`` and ``radius - radius // 2`` on all bits, where whoever meets is within the
radius and is tied to one centre, so that the work stays linear in the crowd.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from acopio.llm.components import connected_components
from acopio.session import stage

BITS = 64
SHINGLE = 3
RADIUS = 3
CROWD = 2048
SEED = 42

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_CHUNK = 1 << 15


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text as a signed number; 0 for a text without words.

    A-Z are lower-cased, words are what stands between white space, and all ``shingle``-word
    runs count, repeats included; a shorter text is one run. A bit is set if it is set in
    over half of the runs' XXH64 hashes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    size = max(1, len(words) - shingle + 1)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, size)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, size, _CHUNK):
        rows = hashes[start : start + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > size, bitorder="little").view(np.int64)[0])


def _simhashes(shingle: int):
    @F.pandas_udf(LongType())
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([simhash(t, shingle) for t in batch], dtype="int64")

    return run


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    return _simhashes(shingle)(text)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def ball(bits: list[int], radius: int) -> list[int]:
    """Masks that change up to ``radius`` of the given bits."""
    return [_signed(sum(1 << b for b in some)) for k in range(radius + 1) for some in combinations(bits, k)]


def _changed(fp: Column, masks: list[int]) -> Column:
    return F.transform(F.lit(masks), lambda m: fp.bitwiseXOR(m))


def _variants(fp: Column, radius: int) -> Column:
    if radius % 2 == 0:
        return _changed(fp, ball(list(range(BITS)), radius // 2))
    parts = []
    for block in np.array_split(np.arange(BITS), 3):
        out = {int(b) for b in block}
        rest = [b for b in range(BITS) if b not in out]
        kept = fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in rest))))
        # the block's place holds a mark, so that variants of different blocks hardly ever meet
        mark = int(block[0]) + 1
        masks = [_signed((m & (2**BITS - 1)) | (1 << mark)) for m in ball(rest, radius // 2)]
        parts.append(_changed(kept, masks))
    return F.concat(*parts)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that tie together what is linked, directly or by others, within one variant."""
    near = _distance(members[:, None], members[None, :]) <= radius
    left, edges = np.ones(len(members), bool), []
    for seed in range(len(members)):
        if not left[seed]:
            continue
        left[seed] = False
        frontier = np.array([seed])
        while len(frontier):
            new = np.flatnonzero(near[frontier].any(axis=0) & left)
            left[new] = False
            edges += [(int(members[seed]), int(members[x])) for x in new]
            frontier = new
    return edges


def _verify(keys: np.ndarray, fps: np.ndarray, radius: int, crowd: int) -> pd.DataFrame:
    """Edges within each variant, and the members of those too crowded to be compared with each other."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    lengths = np.diff(np.r_[starts, len(keys)])
    two = starts[lengths == 2]
    two = two[_distance(fps[two], fps[two + 1]) <= radius]
    several, big = (lengths > 2) & (lengths <= crowd), (lengths > max(2, crowd))
    edges = [e for s, n in zip(starts[several], lengths[several]) for e in _forest(fps[s : s + n], radius)]
    more = np.array(edges, np.int64).reshape(-1, 2)
    a, b = np.r_[fps[two], more[:, 0]], np.r_[fps[two + 1], more[:, 1]]
    tied = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "crowded": False})
    members = fps[np.repeat(big, lengths)]
    return pd.concat([tied, pd.DataFrame({"a": members, "b": members, "crowded": True})]).drop_duplicates()


def _meet(radius: int, crowd: int):
    """Over rows sorted by variant: verified edges, and the members of crowded variants."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = fps = np.empty(0, np.int64)
        crowded = None
        for pdf in batches:
            keys, fps = np.r_[keys, pdf["key"].to_numpy()], np.r_[fps, pdf["fp"].to_numpy()]
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            done = slice(int(np.searchsorted(keys, crowded, "right")) if crowded is not None else 0, last)
            if done.start:  # more of a variant that was found crowded before
                yield pd.DataFrame({"a": fps[: done.start], "b": fps[: done.start], "crowded": True})
            if done.stop > done.start:
                yield _verify(keys[done], fps[done], radius, crowd)
            rest = max(done.start, last)
            keys, fps = keys[rest:], fps[rest:]
            if len(keys) > crowd:
                yield pd.DataFrame({"a": fps, "b": fps, "crowded": True})
                crowded, keys, fps = keys[-1], keys[:0], fps[:0]
        if len(keys):
            yield _verify(keys, fps, radius, crowd)

    return run


def _tie(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows sorted by variant, inner balls first: everyone who meets an inner ball and its centre."""
    key, centre = None, None
    for pdf in batches:
        if pdf.empty:
            continue
        keys, outer, fps = (pdf[c].to_numpy() for c in ("key", "outer", "fp"))
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[starts, len(keys)])
        heads, has = fps[starts].copy(), ~outer[starts].astype(bool)
        if key is not None and keys[0] == key:
            heads[0], has[0] = (centre, True) if centre is not None else (heads[0], False)
        a, ok = np.repeat(heads, lengths), np.repeat(has, lengths)
        ok &= a != fps
        yield pd.DataFrame({"a": np.minimum(a, fps)[ok], "b": np.maximum(a, fps)[ok]}).drop_duplicates()
        key, centre = keys[-1], heads[-1] if has[-1] else None


def links(fps: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that join exactly the fingerprints within ``radius`` bits, directly or by others.

    ``fps`` has one distinct long column ``fp``. Edges tie together what is linked; not every
    linked pair has an edge of its own. Nothing is dropped or capped.
    """
    # as many tasks as a shuffle has: the distinct fingerprints are few bytes, their variants are many rows
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = fps.repartition(tasks, "fp").select("fp", F.explode(_variants(F.col("fp"), radius)).alias("key"))
    met = (
        spread.repartition("key")
        .sortWithinPartitions("key", "fp")
        .mapInPandas(_meet(radius, crowd), "a long, b long, crowded boolean")
        .distinct()
    )
    met = stage(met, "met")
    edges = met.where("not crowded").select("a", "b")
    crowds = met.where("crowded").select(F.col("a").alias("fp")).distinct()
    if crowds.isEmpty():
        return edges
    inner, outer = radius // 2, radius - radius // 2
    crowds = crowds.repartition(tasks, "fp")
    balls = [
        crowds.select("fp", F.lit(far).alias("outer"), F.explode(_changed(F.col("fp"), ball(list(range(BITS)), r))).alias("key"))
        for far, r in ((False, inner), (True, outer))
    ]
    tied = (
        balls[0].unionByName(balls[1])
        .repartition("key")
        .sortWithinPartitions("key", "outer", "fp")
        .mapInPandas(_tie, "a long, b long")
        .distinct()
    )
    return edges.unionByName(tied)


def near_duplicates(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, crowd: int = CROWD, component: str | None = None) -> DataFrame:
    """Each row's fingerprint, component and the number of rows in it.

    ``prints`` has ``id_col`` and a long column ``fp`` (see ``fingerprint``) and should be a
    written table, as it is read more than once. Two rows are linked if their fingerprints
    differ in at most ``radius`` bits; texts without words have fingerprint 0 and are linked
    like any other. ``component_id`` is the smallest id reachable; null ids count as larger
    than any other, and a component of null ids only has none. Repeated rows stay repeated; an
    empty table gives none. Extra columns are passed on, but for those of the new names.
    ``component`` names a further column that tells components apart where ids do not.
    """
    per_fp = stage(prints.groupBy("fp").agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("rows")), "fingerprints")
    found = connected_components(links(per_fp.select("fp"), radius, crowd))
    of_fp = per_fp.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    whole = of_fp.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("component_rows"))
    of_fp = of_fp.select("fp", "component").join(whole, "component")
    of_fp = of_fp.drop("component") if component is None else of_fp.withColumnRenamed("component", component)
    clash = [c for c in ("component_id", "component_rows", component) if c in prints.columns]
    return prints.drop(*clash).join(of_fp, "fp")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
