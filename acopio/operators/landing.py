"""Which listed files are landed, and why the others are not.

The order of the decisions is fixed: expected name, known signature, readiness,
known content. Each step is one join on a well-spread key or one expression.
"""

from __future__ import annotations

import os
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..functions import base_name


def name_window(first: str | None, last: str | None) -> tuple[date, date] | None:
    """Checked ends of a daily window; None when both ends are the default."""
    first = C.NO_DATE if C.is_missing(first) else first
    last = C.NO_DATE if C.is_missing(last) else last
    if first == C.NO_DATE and last == C.NO_DATE:
        return None
    if C.NO_DATE in (first, last):
        raise ValueError(C.MSG_WINDOW_HALF)
    try:
        start, end = (datetime.strptime(x, "%Y-%m-%d").date() for x in (first, last))
    except ValueError as exc:
        raise ValueError(C.MSG_WINDOW_FORMAT) from exc
    if start > end:
        raise ValueError(C.MSG_WINDOW_ORDER)
    return start, end


def expected_names(spark: SparkSession, name: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``file_name`` for each day of the window, or the bare name without a window."""
    window = name_window(first, last)
    if window is None:
        return spark.range(1).select(F.lit(name).alias("file_name"))
    stem, ext = os.path.splitext(name)
    days = F.explode(F.sequence(F.lit(window[0]), F.lit(window[1])))
    return spark.range(1).select(days.alias("day")).select(daily_name(stem, F.col("day"), ext).alias("file_name"))


def daily_name(stem: Column | str, day: Column, ext: Column | str) -> Column:
    stem = F.lit(stem) if isinstance(stem, str) else stem
    ext = F.lit(ext) if isinstance(ext, str) else ext
    return F.concat(stem, F.lit("_"), F.date_format(day, "yyyyMMdd"), ext)


def expected_only(listing: DataFrame, expected: DataFrame) -> DataFrame:
    """Files whose name is expected. There is one expected name per day of the window,
    so the semi join is planned from its true, small size."""
    return (
        listing.withColumn("file_name", base_name("path"))
        .join(expected.select("file_name"), "file_name", "left_semi")
        .drop("file_name")
    )


def known_signatures(checkpoint: DataFrame) -> DataFrame:
    """Distinct complete (relative_path, size, mtime) triples of a landing checkpoint."""
    return (
        checkpoint.select("relative_path", "remote_size", "remote_mtime").dropna().distinct()
    )


def known_hashes(checkpoint: DataFrame) -> DataFrame:
    return checkpoint.where(F.col("hash") != "").select("hash").distinct()


def readiness(
    listing: DataFrame,
    now: Column | int,
    second_listing: DataFrame | None = None,
    skip_wait_age: int = C.READINESS_SKIP_WAIT_AGE_SECONDS,
) -> DataFrame:
    """Adds ``ready``: not empty, and old enough or of the same size in a second listing.

    The second listing needs the young files only; one it lacks counts as still growing.
    """
    now = F.lit(now) if isinstance(now, int) else now
    old_enough = (now - F.col("remote_mtime")) >= skip_wait_age
    if second_listing is None:
        same_size: Column = F.lit(False)
        joined = listing
    else:
        again = second_listing.select("path", F.col("remote_size").alias("size_again"))
        joined = listing.join(again, "path", "left")
        same_size = F.coalesce(F.col("remote_size") == F.col("size_again"), F.lit(False))
    ready = (F.col("remote_size") > 0) & (old_enough | same_size)
    return joined.withColumn("ready", F.coalesce(ready, F.lit(False))).drop("size_again")


def decide_by_metadata(
    listing: DataFrame,
    checkpoint: DataFrame,
    now: Column | int,
    second_listing: DataFrame | None = None,
    skip_wait_age: int = C.READINESS_SKIP_WAIT_AGE_SECONDS,
) -> DataFrame:
    """State, step and message of each file from its metadata alone; content is not touched.

    ``status`` stays NULL for files whose content has to be looked at.
    """
    known = known_signatures(checkpoint).withColumn("known_signature", F.lit(True))
    files = listing.join(known, ["relative_path", "remote_size", "remote_mtime"], "left")
    files = readiness(files, now, second_listing, skip_wait_age)
    known_col = F.coalesce(F.col("known_signature"), F.lit(False))
    not_ready = ~F.col("ready")

    def pick(for_known: str, for_not_ready: str) -> Column:
        return F.when(known_col, F.lit(for_known)).when(not_ready, F.lit(for_not_ready))

    return files.select(
        *[F.col(c) for c in listing.columns],
        pick(C.OMITIDO_YA_PROCESADO, C.OMITIDO_NO_LISTO).alias("status"),
        pick(C.STEP_LOAD, C.STEP_READINESS).alias("stage"),
        pick(C.MSG_KNOWN_SIGNATURE, C.MSG_NOT_READY).alias("message"),
    )


def first_per_content(hashed: DataFrame, checkpoint: DataFrame, order: str = "path") -> DataFrame:
    """Adds ``is_first``: this file brings content neither landed before nor earlier in this run.

    The first path per hash comes from an aggregate (combined before the
    shuffle) and is matched back on (hash, path), so a content shared by a
    large part of all files never meets in one task.
    """
    first = hashed.groupBy("hash").agg(F.min(order).alias(order))
    fresh = first.join(known_hashes(checkpoint), "hash", "left_anti").withColumn("is_first", F.lit(True))
    joined = hashed.join(fresh, ["hash", order], "left")
    return joined.select(
        *[F.col(c) for c in hashed.columns], F.coalesce(F.col("is_first"), F.lit(False)).alias("is_first")
    )


def landing_tally(results: DataFrame) -> DataFrame:
    """One row: files landed, in error, omitted."""
    return results.agg(
        F.count_if(F.col("status") == C.PROCESADO).alias("ok"),
        F.count_if(F.col("status").startswith("ERROR")).alias("errors"),
        F.count_if(F.col("status").startswith("OMITIDO")).alias("omitted"),
    )


def landing_state(tally: DataFrame) -> DataFrame:
    """``estado`` and ``error`` of a landing run from its tally."""
    errors, ok, omitted = F.col("errors"), F.col("ok"), F.col("omitted")

    def text(message: str, n: Column) -> Column:
        before, after = message.split("{n}")
        return F.concat(F.lit(before), n.cast("string"), F.lit(after))

    state = F.when((errors == 0) & (ok > 0), F.lit(C.FINALIZADO)).otherwise(F.lit(C.FALLIDO))
    error = (
        F.when(errors > 0, text(C.MSG_LANDING_ERRORS, errors))
        .when(ok > 0, F.lit(""))
        .when(omitted > 0, text(C.MSG_LANDING_SKIPPED, omitted))
        .otherwise(F.lit(C.MSG_LANDING_NONE))
    )
    return tally.select("*", state.alias("estado"), error.alias("error"))


def landed_paths(results: DataFrame, ordered: bool = True) -> DataFrame:
    """Each landed target once, in path order."""
    paths = results.where(F.col("status") == C.PROCESADO).select(F.col("target").alias("path")).distinct()
    return paths.orderBy("path") if ordered else paths
