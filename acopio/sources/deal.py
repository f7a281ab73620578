"""Files dealt to tasks by their bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What opening a file costs, in bytes; and what a task may hold before there are more of them.
OPENING, PER_TASK = 64 * 1024, 1024**3
_BUCKETS = 1024


def by_bytes(files: DataFrame, size: str = "remote_size", key: str = "path") -> DataFrame:
    """``files`` (a written table) spread so that the heaviest task has at most 1.2 times the mean, or one file.

    A file of over a fifth of a task's share is a task of its own. The others stand in a row and
    are cut where the sum of the bytes before them crosses a multiple of the share. The sums
    are made per bucket of names first, so no task looks at all files. A file without a size
    counts as empty.
    """
    spark = files.sparkSession
    weight = F.coalesce(F.col(size), F.lit(0)) + OPENING
    total, count = files.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count(F.lit(1))).first()
    if count <= 1:
        return files.coalesce(1)
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(cores, -(-total // PER_TASK))
    share = -(-total // tasks)
    big = F.col("_weight") * 5 > share
    weighed = files.withColumn("_weight", weight).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(_BUCKETS)))

    small = weighed.where(~big)
    sums = small.groupBy("_bucket").agg(F.sum("_weight").alias("_in"))
    before = F.sum("_in").over(Window.orderBy("_bucket")) - F.col("_in")
    offsets = sums.select("_bucket", before.alias("_before"))
    within = F.sum("_weight").over(Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_weight")
    cut = small.withColumn("_within", within).join(offsets, "_bucket").withColumn("_task", F.expr(f"cast((_before + _within) div {share} AS int)"))
    # big files are five to a share at most
    alone = weighed.where(big).withColumn("_task", F.row_number().over(Window.orderBy(key)) + F.lit(int(tasks)) - 1)
    dealt = cut.drop("_before", "_within").unionByName(alone)
    n = int(tasks + min(count, 5 * tasks))
    return dealt.drop("_weight", "_bucket").repartitionById(n, F.col("_task")).drop("_task")
