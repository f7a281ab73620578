"""Mixing sources to target weights by systematic sampling.

A source's target is its share of all words, but a document is repeated three times at most,
so a target stops at three times the source; what is over is shared out again. Every document
of a source has the same expected number of copies. Along the source, in order of size, the
expected copies are summed up from one random start, and a document is given once for each
whole number its part of the sum crosses. Ordering by size makes every size be taken alike,
which keeps the words taken close to the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acopio.llm.ranks import ranked
from acopio.llm.text import hash_bucket, n_words
from acopio.session import stage

MOST_COPIES = 3
SEED = "mix"
_DECIMAL = 38


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from one row per source with its ``source_size``.

    Sources in code-point order, null last, weigh 1, 2, 3, 1, ... ; each gets its share of all
    sizes, ``most`` times its own size at most. Sharing out the excess until nobody is above
    is the same as finding the level at which min(limit, level * weight) adds up to the whole,
    which needs one pass in order of limit per weight. One row per source meets in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.select("source", "source_size", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).cast("long").alias("w"))
    limit = F.lit(most) * F.col("source_size")
    filling = Window.orderBy(limit / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (F.col("whole") - F.col("full")) / F.col("left")
    filled = (
        weighed.withColumn("whole", F.sum("source_size").over(everything))
        .withColumn("full", F.sum(limit).over(filling) - limit)
        .withColumn("left", F.sum("w").over(everything) - F.sum("w").over(filling) + F.col("w"))
        # the first source that the level leaves below its limit sets the level for all after it
        .withColumn("level", F.min(F.when(level * F.col("w") < limit, F.struct(limit / F.col("w"), level.alias("at")))).over(everything)["at"])
    )
    target = F.coalesce(F.least(limit.cast("double"), F.col("level") * F.col("w")), limit.cast("double"))
    return filled.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED, most: int = MOST_COPIES, carry: bool = False) -> DataFrame:
    """Every row of ``docs`` with doc_id, size, source, source_size, target and its number of copies.

    A size is the number of words; a null text has none. A source without words takes no
    copies. With ``carry`` each row also holds the whole input row as struct ``row``. The
    random start of a source and the order within a size come from hashes of seed, source and
    id, so runs agree; repeated rows are taken like others. An empty table gives no rows.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    size = n_words(F.col(text_col))
    digits = size.cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.alias("size"),
        # sizes of the same length and first two digits, then parts of those that hold many rows
        F.length(digits).alias("_length"),
        F.substring(digits, 1, 2).alias("_leading"),
        hash_bucket(digest, 1, 2).cast("int").alias("_bucket"),
        digest.alias("_digest"),
        *([F.struct(*(f"`{c}`" for c in docs.columns)).alias("row")] if carry else []),
    )
    rows = stage(rows, "mix-rows")
    totals = stage(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    placed = ranked(rows, ["source"], ["_length", "_leading", "_bucket"], ["size", "_digest", "doc_id"], "_rank")
    joined = placed.join(totals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    start = hash_bucket(F.md5(F.concat(F.lit(f"{seed}:start:"), F.coalesce("source", F.lit("")))), 1, 8) / F.lit(2.0**32)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor(F.col("_rank") * rate + start) - F.floor((F.col("_rank") - 1) * rate + start)
    kept = ["doc_id", "source", "size", "source_size", "target", *(["row"] if carry else [])]
    return joined.select(*kept, F.least(crossed, F.lit(most)).cast("long").alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix holds it: each row as often as it is taken."""
    taken = copies(docs, carry=True, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
