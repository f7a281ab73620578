"""Positions of rows in a global order, dealt out in buckets so that no task sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acopio.session import stage


def ranked(df: DataFrame, group: list[str], buckets: list[str], order: list[Column | str], rank: str) -> DataFrame:
    """``df``, a written table, with the 1-based place of each row in its group.

    Rows of a group are ordered by the bucket columns, then by ``order``. The rows before a
    bucket are summed from the counts of the buckets; only within a bucket are rows sorted.
    Bucket columns hold no nulls; nulls in ``group`` are a group. ``rank`` must be a new name.
    """
    before = "_rows_before"
    # a key that is never null: the plain join below then needs no other shuffle than the window
    keys = [F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")).alias(f"_g{i}") for i, g in enumerate(group)]
    groups = [f"_g{i}" for i in range(len(group))]
    keyed = df.select("*", *keys)
    counts = keyed.groupBy(*groups, *buckets).agg(F.count(F.lit(1)).alias(before))
    running = Window.partitionBy(*groups).orderBy(*buckets)
    offsets = stage(counts.withColumn(before, F.sum(before).over(running) - F.col(before)), "offsets")
    within = keyed.withColumn(rank, F.row_number().over(Window.partitionBy(*groups, *buckets).orderBy(*order)).cast("long"))
    joined = within.join(offsets, [*groups, *buckets])
    return joined.withColumn(rank, F.col(rank) + F.col(before)).drop(before, *groups)
