"""Existing tables: checkpoints, targets, the catalog, parameter rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, types as T

from .. import contracts as C
from ..swap import Folder, hadoop_path, settle


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path, such as a table's partitions."""
    fs, p = hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def first_file(spark: SparkSession, path: str) -> str | None:
    """Some data file of a table, looked for in its last folder first; None without any.

    Hidden entries are not looked into. Of a table by period the names of its periods are
    listed, and the files of one of them.
    """
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    shown = [s for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))]
    for entry in sorted(shown, key=lambda s: (s.isDirectory(), s.getPath().getName()), reverse=True):
        found = first_file(spark, entry.getPath().toString()) if entry.isDirectory() else entry.getPath().toString()
        if found is not None:
            return found
    return None


def has_files(spark: SparkSession, path: str) -> bool:
    """True when a table folder holds data files and not only an empty folder."""
    return first_file(spark, path) is not None


def is_delta(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_delta_log")


def delta_available(spark: SparkSession) -> bool:
    """Whether the Delta connector is on the session's class path."""
    try:
        return spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension") is not None
    except Exception:
        return False


def table_exists(spark: SparkSession, collection: str | None, table: str) -> int:
    """1 when the catalog knows the table, 0 otherwise or when it cannot be asked."""
    try:
        return int(spark.catalog.tableExists(f"`{collection}`.`{table}`" if collection else f"`{table}`"))
    except Exception:
        return 0


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A table as it is once replacements that were decided are finished."""
    if fmt == "parquet":
        settle(spark, path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_entries(spark: SparkSession, path: str, entries: list[str], schema: T.StructType) -> DataFrame:
    """Some partition folders of a parquet table; nothing else of it is listed."""
    if not entries:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{e}" for e in entries])


def target_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> T.StructType | None:
    """Columns and types of an existing target, from one of its files; None when there is none yet.

    Columns that are folder names of a parquet table are not among them.
    """
    if fmt == "delta":
        return read_table(spark, path, "delta").schema if is_delta(spark, path) else None
    if fmt != "parquet":
        return read_table(spark, path, fmt).schema if has_files(spark, path) else None
    settle(spark, path)
    found = first_file(spark, path)
    return None if found is None else spark.read.parquet(found).schema


def entries_of(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a table: its files, or the folders of its periods."""
    settle(spark, path)
    return Folder(spark, path).children()


def read_checkpoint(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A checkpoint in its full layout; columns an older one lacks are NULL.

    Only a checkpoint that does not exist counts as empty. One that cannot be
    read is an error: taking it for empty would process everything again.
    """
    if not has_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def parameter_rows(params: DataFrame | None) -> Iterator[Row]:
    """Rows of a control table, one after the other, however many there are."""
    return iter(()) if params is None else params.toLocalIterator()


def first_row(params: DataFrame | None) -> Row | None:
    """The row of a control table that has one; None without rows."""
    return None if params is None else params.first()


def parameter(row: Row | None, name: str, default: object = None) -> object:
    """A parameter value; NULL, blank text and an absent column give the default."""
    value = row[name] if row is not None and name in row.__fields__ else None
    return default if C.is_missing(value) else value


__all__ = [
    "child_folders",
    "delete_path",
    "delta_available",
    "entries_of",
    "first_file",
    "first_row",
    "has_files",
    "is_delta",
    "parameter",
    "parameter_rows",
    "path_exists",
    "read_checkpoint",
    "read_entries",
    "read_table",
    "table_exists",
    "target_schema",
]
