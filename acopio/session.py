"""Where intermediate tables go, and how a plan is cut with a written table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach. The session names it; local runs may make one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="acopio-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/acopio/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Later plans start from the written files, so a lost executor costs a
    re-read and no upstream recomputation, side effects upstream happen once, and
    the optimiser knows the real size when it picks a join strategy.
    """
    spark = df.sparkSession
    target = scratch_path(spark, label)
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` for work that ends here: the written table is removed when it succeeded.

    After a failure it stays, so that rows whose target was being replaced are not lost.
    """
    spark = df.sparkSession
    target = scratch_path(spark, label)
    df.write.parquet(target)
    yield spark.read.schema(df.schema).parquet(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
