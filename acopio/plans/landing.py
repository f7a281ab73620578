"""Stage 1: files of a source tree into the landing zone, each content once."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..operators import landing
from ..session import stage
from ..sinks.landing_zone import copy_files, with_content_hash
from ..sources import tables
from ..sources.listing import sizes_now, walk_tree


@dataclass
class LandingRun:
    """``outcome``: landed paths, or a failed status. ``results``: one row per file looked at."""

    outcome: DataFrame
    results: DataFrame | None = None
    landed: DataFrame | None = None


_REQUIRED = ("source_uri", "landing_uri", "NOMBRE_ARCHIVO")


def _int_option(options: dict, name: str, default: int) -> int:
    try:
        return int(str(options.get(name, default)).strip())
    except ValueError:
        return default


def land(spark: SparkSession, params: DataFrame, options: dict, store_options: dict | None = None) -> LandingRun:
    """Land the expected, ready and new files named by one parameter row.

    ``params``: ``source_uri, landing_uri, NOMBRE_ARCHIVO`` and optionally
    ``FECHA_DESDE, FECHA_HASTA``. ``options``: ``relative_upload_file_path``,
    ``relative_upload_control_path``, ``readiness_wait_seconds``,
    ``readiness_skip_wait_age_seconds``.
    """
    log = C.StepLog()
    log.add(C.LOG_START)

    def failed(message: str) -> LandingRun:
        return LandingRun(C.status_frame(spark, C.FALLIDO, message, log))

    missing = C.missing_columns(params.columns, _REQUIRED)
    if missing:
        return failed(C.MSG_MISSING_COLUMNS + ", ".join(missing))
    row = params.first()
    if row is None:
        return failed(C.MSG_NO_PARAMETERS)
    values = {n: tables.parameter(row, n) for n in _REQUIRED}
    for name in _REQUIRED:
        if values[name] is None:
            return failed(C.MSG_MISSING_PARAMETER.format(name=name))
    for name in ("relative_upload_file_path", "relative_upload_control_path"):
        if C.is_missing(options.get(name)):
            return failed(C.MSG_MISSING_PARAMETER.format(name=name))
    try:
        expected = landing.expected_names(
            spark,
            values["NOMBRE_ARCHIVO"],
            tables.parameter(row, "FECHA_DESDE", C.NO_DATE),
            tables.parameter(row, "FECHA_HASTA", C.NO_DATE),
        )
    except ValueError as exc:
        return failed(C.error_text(exc))

    wait = _int_option(options, "readiness_wait_seconds", C.READINESS_WAIT_SECONDS)
    skip_age = _int_option(options, "readiness_skip_wait_age_seconds", C.READINESS_SKIP_WAIT_AGE_SECONDS)
    landing_uri = values["landing_uri"].rstrip("/")
    prefix = options["relative_upload_file_path"].strip("/")
    control = _checkpoint_path(landing_uri, options)
    try:
        results, landed = _run(
            spark, values["source_uri"], expected, control, landing_uri, prefix, wait, skip_age, store_options, log
        )
    except Exception as exc:
        log.add(C.LOG_LANDING_FAILED.format(detail=C.error_text(exc)))
        return failed(C.error_text(exc))

    state = landing.landing_state(landing.landing_tally(results)).first()
    log.add(C.LOG_LANDING_SUMMARY.format(ok=state.ok, errors=state.errors, omitted=state.omitted))
    paths = landing.landed_paths(results)
    if state.estado == C.FALLIDO:
        return LandingRun(C.status_frame(spark, C.FALLIDO, state.error, log), results, paths)
    return LandingRun(paths, results, paths)


def _checkpoint_path(landing_uri: str, options: dict) -> str:
    return f"{landing_uri.rstrip('/')}/{options['relative_upload_control_path'].strip('/')}/{C.CHECKPOINT_FOLDER}"


def landed_so_far(spark: SparkSession, landing_uri: str, options: dict) -> DataFrame:
    """``path`` of every file landed by any run, also by runs that ended with errors."""
    known = tables.read_checkpoint(spark, _checkpoint_path(landing_uri, options), C.LANDING_CHECKPOINT)
    return known.select(F.concat(F.lit(landing_uri.rstrip("/") + "/"), F.col("s3_key")).alias("path"))


def _run(
    spark: SparkSession,
    source_uri: str,
    expected: DataFrame,
    control: str,
    landing_uri: str,
    prefix: str,
    wait: int,
    skip_age: int,
    store_options: dict | None,
    log: C.StepLog,
) -> tuple[DataFrame, DataFrame]:
    checkpoint = tables.read_checkpoint(spark, control, C.LANDING_CHECKPOINT)
    found, walk_errors = walk_tree(spark, source_uri, store_options)
    listing = landing.expected_only(found, expected)
    now = int(time.time())
    young = listing.where((F.lit(now) - F.col("remote_mtime")) < skip_age)
    again = None
    if not young.isEmpty():
        # one wait for the whole run, then one more look at the young files
        time.sleep(wait)
        again = stage(sizes_now(young, store_options), "landing-again")
    decided = stage(landing.decide_by_metadata(listing, checkpoint, now, again, skip_age), "landing-decided")

    open_files = decided.where(F.col("status").isNull()).select(*C.LISTING.fieldNames())
    hashed = stage(with_content_hash(open_files, store_options), "landing-hashed")
    readable = hashed.where(F.col("hash").isNotNull())
    judged = stage(landing.first_per_content(readable, checkpoint), "landing-judged")
    to_copy = judged.where("is_first").drop("is_first").unionByName(hashed.where(F.col("hash").isNull()))
    copied = stage(copy_files(to_copy, landing_uri, prefix, store_options), "landing-copied")

    landed = copied.where(F.col("status") == C.PROCESADO)
    names = [f for f in C.LANDING_CHECKPOINT.fieldNames() if f != "ingestion_ts"]
    if not landed.isEmpty():
        # once per run, in files of a sensible size
        known = landed.select(*names).withColumn("ingestion_ts", F.current_timestamp())
        known.hint("rebalance").write.mode("append").parquet(control)
        log.add(C.LOG_CHECKPOINT)

    fields = C.LANDING_RESULT.fieldNames()
    skipped = decided.where(F.col("status").isNotNull()).select(
        F.col("path").alias("source"), F.lit("").alias("target"), "status", "stage", "message"
    )
    repeated = judged.where("NOT is_first").select(
        F.col("path").alias("source"),
        F.lit("").alias("target"),
        F.lit(C.OMITIDO_YA_PROCESADO).alias("status"),
        F.lit(C.STEP_LOAD).alias("stage"),
        F.lit(C.MSG_KNOWN_HASH).alias("message"),
    )
    results = copied.select(*fields).unionByName(skipped).unionByName(repeated).unionByName(walk_errors)
    return results, landed
