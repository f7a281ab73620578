"""Which files are known, which are still to be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..contracts import MANIFEST, PENDIENTE
from ..functions import blank


def manifest_from_paths(paths: DataFrame) -> DataFrame:
    """``path`` column to manifest rows: non-empty, each path once, state PENDIENTE."""
    return (
        paths.where(F.col("path").isNotNull() & (F.col("path") != ""))
        .select("path")
        .distinct()
        .select(
            "path",
            F.lit(PENDIENTE).alias("discovery_status"),
            F.lit(None).cast("string").alias("error_message"),
            F.col("path").alias("source_file"),
        )
    )


def processed_paths(checkpoint: DataFrame) -> DataFrame:
    """Every path a reader checkpoint names, whether as ``path`` or as ``source_file``.

    ``source_file`` counts too: once members of an archive were read, the archive
    itself is done.
    """
    named = [c for c in ("path", "source_file") if c in checkpoint.columns]
    if not named:
        return checkpoint.sparkSession.createDataFrame([], "path string")
    # one scan of the checkpoint: both columns go out of the same row
    each = checkpoint.select(F.explode(F.array(*[F.col(c).cast("string") for c in named])).alias("path"))
    return each.where(F.col("path").isNotNull() & (F.col("path") != "")).distinct()


def exclude_processed(manifest: DataFrame, checkpoint: DataFrame) -> DataFrame:
    return manifest.join(processed_paths(checkpoint), "path", "left_anti")


def with_defaults(manifest: DataFrame) -> DataFrame:
    """Manifest columns filled in: state PENDIENTE, source file the path itself."""
    for name in MANIFEST.fieldNames():
        if name not in manifest.columns:
            manifest = manifest.withColumn(name, F.lit(None).cast("string"))
    return manifest.select(
        F.col("path").cast("string").alias("path"),
        F.coalesce(F.col("discovery_status"), F.lit(PENDIENTE)).alias("discovery_status"),
        F.col("error_message").cast("string").alias("error_message"),
        F.coalesce(F.col("source_file"), F.col("path")).cast("string").alias("source_file"),
    ).distinct()


def pending_files(manifest: DataFrame) -> DataFrame:
    return manifest.where((F.col("discovery_status") == PENDIENTE) & ~blank("path"))


def inherited_errors(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.upper(F.col("discovery_status")).startswith("ERROR"))
