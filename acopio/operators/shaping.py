"""Projections between the read rows and a target table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import contracts as C
from ..functions import base_name
from ..functions.fingerprint import quoted


def strings(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c).cast("string").alias(c) for c in df.columns])


def drop_control(df: DataFrame) -> DataFrame:
    """Without the control columns, however they are capitalised."""
    control = {c.lower() for c in C.CONTROL_COLUMNS}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in control])


def extra_expressions(text: str | Iterable[str] | None) -> list[str]:
    """SQL expressions from a ``;`` list. Pass a list when a literal holds a semicolon."""
    if text is None:
        return []
    parts = text.split(";") if isinstance(text, str) else list(text)
    return [p.strip() for p in parts if p.strip()]


def with_extras(df: DataFrame, extras: str | Iterable[str] | None) -> DataFrame:
    return df.selectExpr("*", *extra_expressions(extras))


def _recast(df: DataFrame, target: T.StructType | None) -> dict[str, T.DataType]:
    """Columns of ``df`` the target holds with another type, by name in any case."""
    wanted = {f.name.lower(): f.dataType for f in target or []}
    return {
        f.name: wanted[f.name.lower()]
        for f in df.schema
        if f.name.lower() in wanted and wanted[f.name.lower()] != f.dataType
    }


def cast_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns the target has take its type; a value that does not fit is NULL. New columns pass."""
    recast = _recast(df, target)
    return df.select(
        *[quoted(c).try_cast(recast[c]).alias(c) if c in recast else quoted(c) for c in df.columns]
    )


def lost_values(df: DataFrame, target: T.StructType | None) -> Column:
    """How many values of a row the cast to the target turns into NULL."""
    lost: Column = F.lit(0)
    for name, to in _recast(df, target).items():
        source = quoted(name)
        lost = lost + (source.isNotNull() & source.try_cast(to).isNull()).cast("int")
    return lost


def lineage(
    df: DataFrame, *, source_file: Column, path: Column, batch: Column, dataset: Column, ingestion_ts: Column
) -> DataFrame:
    """Rows with the eight lineage columns after the user's own.

    A user column with the name of a lineage or status column is kept under
    ``origen_<name>``.
    """
    reserved = {c.lower() for c in (*C.LINEAGE.fieldNames(), *C.STATUS.fieldNames())}
    own = [
        quoted(c).alias(f"origen_{c}") if c.lower() in reserved else quoted(c) for c in df.columns
    ]
    null = F.lit(None).cast("string")
    return df.select(
        *own,
        ingestion_ts.alias("ingestion_ts"),
        source_file.alias("source_file"),
        path.alias("path"),
        batch.alias("batch_id"),
        dataset.alias("dataset"),
        F.lit(C.PROCESADO).alias("record_status"),
        null.alias("error_stage"),
        null.alias("error_message"),
    )


def finish(rows: DataFrame) -> DataFrame:
    """User columns, then ``fecha_ingesta, batch_id, nombre_archivo``."""
    technical = set(C.LINEAGE.fieldNames())
    own = [quoted(c) for c in rows.columns if c not in technical]
    return rows.select(
        *own,
        F.col("ingestion_ts").alias("fecha_ingesta"),
        F.col("batch_id"),
        base_name("source_file").alias("nombre_archivo"),
    )


def error_rows(errors: DataFrame) -> DataFrame:
    """``path, record_status, error_message, source_file, dataset`` in the layout of the read rows."""
    null = F.lit(None).cast("string")
    return errors.select(
        "path",
        "record_status",
        "error_message",
        null.alias("ingestion_ts"),
        "source_file",
        null.alias("batch_id"),
        "dataset",
        F.lit(C.STEP_READ).alias("error_stage"),
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame | None:
    """Union by name, NULL where a frame lacks a column; None for no frames.

    Neighbours are joined pairwise so that the plan stays shallow for many groups.
    """
    todo = list(frames)
    while len(todo) > 1:
        pairs = [todo[i : i + 2] for i in range(0, len(todo), 2)]
        todo = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) == 2 else p[0] for p in pairs]
    return todo[0] if todo else None
