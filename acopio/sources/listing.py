"""Listing files: by Spark's file index, or level by level when every directory counts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import contracts as C
from ..functions import relative_path
from ..operators.shaping import union_all
from ..session import stage
from .deal import OPENING
from .store import Store, spread, split_uri


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """``path, length, modificationTime`` of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
        .select("path", "length", "modificationTime")
    )


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING_CACHE = "spark.sql.hive.filesourcePartitionFileCacheSize"
_OPEN_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def _at_most(spark: SparkSession, name: str, most: int) -> Iterator[None]:
    """A number among the session's settings lowered; a smaller one that the session was given stays."""
    given = spark.conf.get(name, None)
    if given is None or not given.isdigit() or int(given) > most:
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, given)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Spark lists the given paths of a scan in tasks of many paths each.

    Left to itself it has a task per path, up to 10,000, which cost far more than the look at
    a file. A smaller number that the session was given stays. The driver's cache of listings
    (up to 250 MB) is left alone: no scan uses what another one put there.
    """
    with _at_most(spark, _LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism), _at_most(spark, _LISTING_CACHE, 0):
        yield


def small_files_together(spark: SparkSession):
    """Tasks of a scan take a few thousand small files and not 32, so that what they write is as few files; all cores still get some."""
    return _at_most(spark, _OPEN_COST, OPENING)


def as_listing(files: DataFrame, root: str) -> DataFrame:
    """A file listing in the landing layout."""
    return files.select(
        "path",
        relative_path("path", root).alias("relative_path"),
        F.col("length").alias("remote_size"),
        F.unix_seconds("modificationTime").alias("remote_mtime"),
    )


_ROWS_PER_FRAME = 10_000
_ENTRY = "parent string, path string, kind string, remote_size bigint, remote_mtime bigint, message string"


def walk_tree(spark: SparkSession, root: str, store_options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """All files of a tree in the landing layout, and one result row per directory that cannot be listed.

    Each level of the tree is one distributed job over its directories. The
    level is written down before the next one starts, so a lost executor
    repeats a few directory listings only.
    """

    def list_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        found: list[tuple] = []
        for batch in batches:
            for directory in batch["dir"]:
                for entry in _list_one(store, directory):
                    found.append(entry)
                    if len(found) == _ROWS_PER_FRAME:
                        yield _entries(found)
                        found = []
        # directories of a few files each share a frame
        yield _entries(found)

    level = spark.createDataFrame([(root.rstrip("/") or "/",)], "dir string")
    levels: list[DataFrame] = []
    while not level.isEmpty():
        listed = stage(spread(level, "dir").mapInPandas(list_directories, _ENTRY), "walk")
        levels.append(listed)
        level = listed.where("kind = 'dir'").select(F.col("path").alias("dir"))
    everything = union_all(levels)
    files = everything.where("kind = 'file'").select(
        "path", relative_path("path", root.rstrip("/")).alias("relative_path"), "remote_size", "remote_mtime"
    )
    errors = everything.where("kind = 'error'").select(
        F.col("path").alias("source"),
        F.lit("").alias("target"),
        F.lit(C.ERROR_DESCUBRIMIENTO).alias("status"),
        F.lit(C.STEP_DISCOVERY).alias("stage"),
        "message",
    )
    return files, errors


def _list_one(store: Store, directory: str) -> Iterator[tuple]:
    try:
        fs, path = store.at(directory)
        entries = fs.get_file_info(pafs.FileSelector(path, recursive=False))
    except Exception as exc:  # a directory that cannot be listed is a result, not a failure
        yield (directory, directory, "error", None, None, C.error_text(exc))
        return
    for e in entries:
        kind = "dir" if e.type == pafs.FileType.Directory else "file"
        mtime = int(e.mtime_ns // 1_000_000_000) if e.mtime_ns is not None else None
        yield (directory, directory.rstrip("/") + "/" + e.base_name, kind, e.size, mtime, None)


def _entries(found: list[tuple]) -> pd.DataFrame:
    columns = [f.split()[0] for f in _ENTRY.split(", ")]
    return pd.DataFrame(found, columns=columns).astype({"remote_size": "Int64", "remote_mtime": "Int64"})


def sizes_now(files: DataFrame, store_options: dict | None = None) -> DataFrame:
    """``path, remote_size`` of the given files as they are at this moment; files that went away are left out."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store(store_options)
        for batch in batches:
            sizes = [store.info(p).size for p in batch["path"]]
            found = pd.DataFrame({"path": batch["path"], "remote_size": pd.array(sizes, dtype="Int64")})
            yield found.dropna()

    return spread(files.select("path"), "path").mapInPandas(look, "path string, remote_size bigint")


def qualified(path: "F.Column", spark: SparkSession) -> "F.Column":
    """Paths as Spark's file metadata spells them: with a scheme, local ones as ``file:/``."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    scheme, authority, _ = split_uri(default)
    prefix = "file:" if scheme in ("", "file") else f"{scheme}://{authority}"
    spelled = F.regexp_replace(path, r"^file:/+", "file:/")
    return F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), spelled).otherwise(F.concat(F.lit(prefix), path))
