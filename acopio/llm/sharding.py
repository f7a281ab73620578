"""Shards that each hold the corpus mixture: proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; a row's fractional rank, its
place over the rows of its source, spreads every source evenly over (0, 1). Sorting all rows
by fractional rank and cutting the order in equal parts gives shards whose row counts
differ by one at most and whose sources have the shares that they have in the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acopio.llm.ranks import ranked
from acopio.llm.text import hash_bucket
from acopio.session import stage

OVERHEAD = 16


def size_of(text: Column) -> Column:
    """Bytes of the UTF-8 text (null: none) plus a fixed cost per row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def shards(docs: DataFrame, n: int, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "interleave") -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) of every row.

    ``slot`` is the place within the shard, without gaps from 0. A null source is a source of
    its own; null texts have size 16 and crc32 0. Rows with equal ids are ordered by size and
    crc32; what still ties is equal in every returned column. With fewer rows than shards some
    shards are empty; an empty table gives no rows. Other columns are not looked at.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            size_of(F.col(text_col)).alias("size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
            digest.alias("_digest"),
            hash_bucket(digest, 1, 3).cast("int").alias("_bucket"),
        ),
        "shard-rows",
    )
    order = ["_digest", "doc_id", "size", "text_crc32"]
    placed = ranked(rows, ["source"], ["_bucket"], order, "_rank")
    totals = stage(rows.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_total")), "shard-sources")
    total = rows.count()
    place = (2 * F.col("_rank") - 1) / (2 * F.col("_total"))
    spread = placed.join(totals, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_place", place)
    # the places are even over (0, 1), so these buckets are too
    spread = stage(spread.withColumn("_bucket", F.floor(F.col("_place") * 4096).cast("int")).drop("_source", "_total", "_rank"), "shard-places")
    ordered = ranked(spread, [], ["_bucket"], ["_place", "source", *order], "_at")
    at = F.col("_at") - 1
    shard = F.floor(at * n / F.lit(max(1, total))).cast("int")
    first = F.ceil(F.lit(total) * F.col("shard") / F.lit(n))
    return (
        ordered.withColumn("shard", shard)
        .withColumn("slot", (at - first).cast("long"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
