"""Stage 2: the files still to be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..operators import discovery
from ..sources import tables
from ..sources.listing import qualified, walk_tree


def root_uri(bucket: str) -> str:
    """A bucket name, or any folder URI or absolute path taken as it is."""
    return bucket.rstrip("/") if "/" in bucket or ":" in bucket else f"s3a://{bucket}"


def discover(
    spark: SparkSession,
    upload: DataFrame | None,
    params: DataFrame | None = None,
    options: dict | None = None,
    store_options: dict | None = None,
) -> DataFrame:
    """Pending files: those landed, or those below the landing prefix, without those already read.

    ``upload`` is the outcome of landing (paths or a status) or None to list the
    prefix. ``params`` holds ``BUCKET_BLOB, BUCKET_RAW``; ``options`` holds
    ``relative_upload_file_path`` and ``checkpoint_prefix``.
    """
    options = options or {}
    log = C.StepLog()
    log.add(C.LOG_START)
    row = tables.first_row(params)
    blob, raw = tables.parameter(row, "BUCKET_BLOB"), tables.parameter(row, "BUCKET_RAW")

    def failed(message: str) -> DataFrame:
        return C.status_frame(spark, C.FALLIDO, message, log)

    columns = upload.columns if upload is not None else []
    if C.is_status(columns):
        if C.failed_status(upload):
            return upload.select(*C.STATUS.fieldNames())
        return failed(C.MSG_STATUS_WITHOUT_PATHS)
    if "path" in columns:
        log.add(C.LOG_PATHS)
        manifest = discovery.manifest_from_paths(upload)
    else:
        prefix = options.get("relative_upload_file_path")
        if blob is None:
            return failed(C.MSG_MISSING_PARAMETER_IN.format(name="BUCKET_BLOB", frame=C.FRAME_DISCOVERY))
        if C.is_missing(prefix):
            return failed(C.MSG_MISSING_PARAMETER.format(name="relative_upload_file_path"))
        log.add(C.LOG_STANDALONE)
        manifest = _walked(spark, f"{root_uri(blob)}/{prefix.strip('/')}/{C.ZONE_ORIGINAL}", store_options)

    checkpoint_prefix = options.get("checkpoint_prefix")
    if raw is None:
        return failed(C.MSG_MISSING_PARAMETER_IN.format(name="BUCKET_RAW", frame=C.FRAME_DISCOVERY))
    if C.is_missing(checkpoint_prefix):
        return failed(C.MSG_MISSING_PARAMETER.format(name="checkpoint_prefix"))
    path = checkpoint_path(raw, checkpoint_prefix)
    if not tables.has_files(spark, path):
        return manifest
    # read in its full layout: older files of it may lack a column
    return discovery.exclude_processed(manifest, tables.read_checkpoint(spark, path, C.READER_CHECKPOINT))


def _walked(spark: SparkSession, root: str, store_options: dict | None) -> DataFrame:
    """A manifest of everything below a folder, listed by tasks; the driver holds no names.

    Paths are spelled as Spark spells them. Hidden files are left out, as Spark's readers do.
    A directory that cannot be listed is an entry with its error; the root must be there.
    """
    files, errors = walk_tree(spark, root, store_options)
    lost = errors.where(F.col("source") == root).first()
    if lost is not None:
        raise FileNotFoundError(lost.message)
    shown = files.where(~F.col("relative_path").rlike("(^|/)[._]"))
    found = discovery.manifest_from_paths(shown.select(qualified(F.col("path"), spark).alias("path")))
    failed = errors.select(
        F.lit(None).cast("string").alias("path"), F.col("status").alias("discovery_status"), F.col("message").alias("error_message"),
        qualified(F.col("source"), spark).alias("source_file"),
    )
    return found.unionByName(failed)


def checkpoint_path(bucket_raw: str, checkpoint_prefix: str) -> str:
    return f"{root_uri(bucket_raw)}/{checkpoint_prefix.strip('/')}"


def commit(files: DataFrame, path: str) -> None:
    """Record files as read (``path, source_file``), after their rows were written."""
    files.select(*C.READER_CHECKPOINT.fieldNames()).hint("rebalance").write.mode("append").parquet(path)
