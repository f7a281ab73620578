"""Packing documents into training sequences: best fit under conflicts.

A bin takes ``capacity`` words. Documents come in order of falling size; each goes to the
compatible bin with the least room that it still fits in. Bins are kept in order of their
residual room, so the search starts at the tightest bin that fits and goes on to the next
one until one is compatible; if none is, a new bin is opened. A bin carries bitmaps of the
sources and of the duplicate clusters in it: a document can't join a bin that has its
cluster, or that has its source ``per_source`` times already (one bitmap for each time).

Rows are dealt evenly over groups of about ``group_rows`` rows, and each group is packed on
its own, so that memory is bounded and a hot source or cluster spreads over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acopio.llm import simhash
from acopio.llm.text import n_words, words
from acopio.session import stage

CAPACITY = 4096
PER_SOURCE = 4
GROUP_ROWS = 20_000

#: Ids and clusters go through Python as texts: as numbers, a null would turn them into floats.
SCHEMA = "doc_id string, piece int, n_words long, source string, cluster string, bin string, place int, start long"


def best_fit(items: list[tuple[int, object, object]], capacity: int, per_source: int) -> list[int]:
    """The bin of each item (size, source, cluster); a null source or cluster conflicts with nothing."""
    counts = [Counter(x[k] for x in items if x[k] is not None) for k in (1, 2)]
    # only what stands twice or more can conflict, so only that gets a bit
    bits = [{v: 1 << i for i, v in enumerate(sorted(v for v, n in c.items() if n > 1))} for c in counts]
    bins: list[tuple[int, int]] = []  # (room, bin), in order
    sources: list[list[int]] = []  # bitmap k of a bin: the sources in it more than k times
    clusters: list[int] = []
    placed = [0] * len(items)
    for at in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, source, cluster = items[at]
        s, c = bits[0].get(source, 0), bits[1].get(cluster, 0)
        k = bisect_left(bins, (size, -1))
        while k < len(bins) and (clusters[bins[k][1]] & c or sources[bins[k][1]][-1] & s):
            k += 1
        if k < len(bins):
            room, b = bins.pop(k)
        else:
            room, b = capacity, len(clusters)
            sources.append([0] * per_source)
            clusters.append(0)
        clusters[b] |= c
        for level, held in enumerate(sources[b]):
            if not held & s:
                sources[b][level] |= s
                break
        placed[at] = b
        if room > size:
            insort(bins, (room - size, b))
    return placed


def _pack(capacity: int, per_source: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [pdf for pdf in batches if len(pdf)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True).sort_values(["n_words", "doc_id", "piece", "source", "cluster"], ascending=[False, True, True, True, True], kind="stable", ignore_index=True)
        nulls = [rows[c].isna() for c in ("source", "cluster")]
        items = [
            (int(n), None if a else s, None if b else c)
            for n, s, c, a, b in zip(rows["n_words"], rows["source"], rows["cluster"], *nulls)
        ]
        bins = pd.Series(best_fit(items, capacity, per_source))
        rows["bin"] = rows["group"].astype(str) + "-" + bins.astype(str)
        rows["place"] = rows.groupby("bin").cumcount().astype("int32")
        rows["start"] = rows.groupby("bin")["n_words"].cumsum() - rows["n_words"]
        yield rows.drop(columns="group")

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, piece, n_words, source, cluster, bin, place, start) of every piece of every row.

    ``items`` has doc_id long, source string, cluster long and n_words. A row larger than a
    bin is cut: full pieces have a bin to themselves, the rest is packed like any other row
    (its pieces have the row's cluster, so they stay in different bins). A row without words is
    packed with size 0; null n_words count as 0. Null sources and clusters conflict with
    nothing; null ids are passed on. Equal rows are packed each for itself. An empty table gives no rows.
    """
    items = stage(items.select(F.col("doc_id").cast("string"), "source", F.col("cluster").cast("string"), F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words")), "pack-items")
    pieces = F.greatest(F.ceil(F.col("n_words") / capacity), F.lit(1)).cast("int")
    cut = items.select("doc_id", "source", "cluster", F.col("n_words").alias("whole"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    cut = cut.select("doc_id", "piece", "source", "cluster", F.least(F.lit(capacity), F.col("whole") - F.col("piece").cast("long") * capacity).alias("n_words"))
    cut = stage(cut, "pack-pieces")
    full = cut.where(F.col("n_words") == capacity).select("doc_id", "piece", "n_words", "source", "cluster", F.concat(F.lit("full-"), F.monotonically_increasing_id().cast("string")).alias("bin"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("start"))
    rest = cut.where(F.col("n_words") < capacity)
    groups = max(1, -(-rest.count() // group_rows))
    # dealt in turn, not by a key: each group gets its even part of any hot source or cluster
    dealt = rest.repartition(groups).withColumn("group", F.spark_partition_id())
    packed = dealt.mapInPandas(_pack(capacity, per_source), SCHEMA).unionByName(full)
    return packed.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("cluster", F.col("cluster").cast("long"))


def clusters(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Items to pack: the cluster is the hash of a text's words, so copies share one; texts without words have none."""
    w = F.col("w")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), words(F.lower(F.col(text_col))).alias("w")).select(
        "doc_id", "source", F.when(F.size(w) > 0, F.xxhash64(F.array_join(w, " "))).alias("cluster"), F.size(w).cast("long").alias("n_words")
    )


def near_clusters(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Items to pack: the cluster is the component of near-duplicate fingerprints, so near copies share one too.

    Texts without words have none, though their fingerprints are equal.
    """
    prints = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("n_words"),
        simhash.fingerprint(F.col(text_col)).alias("fp"),
    )
    marked = simhash.near_duplicates(stage(prints, "pack-prints"), component="cluster")
    return marked.select("doc_id", "source", F.when(F.col("n_words") > 0, F.col("cluster")).alias("cluster"), "n_words")
