"""Counts, ranges, checksums and the comparison of what was sent with what arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import checksum
from ..functions.fingerprint import quoted


def write_summary(control: str | None) -> list[Column]:
    """Aggregates of a write: row count and the range of the control expression as text."""
    value = F.expr(control) if control else F.lit(None)
    return [
        F.count(F.lit(1)).alias("cantidad_insertados"),
        F.min(value).cast("string").alias("rango_ini_procesado"),
        F.max(value).cast("string").alias("rango_fin_procesado"),
    ]


def period_range(df: DataFrame, period: str = "periodo") -> DataFrame:
    return df.agg(
        F.date_format(F.min(quoted(period)), "yyyy-MM-dd").alias("rango_ini"),
        F.date_format(F.max(quoted(period)), "yyyy-MM-dd").alias("rango_fin"),
    )


def last_period(df: DataFrame, period: str = "periodo") -> DataFrame:
    """Greatest period as text, '' without rows."""
    return df.agg(F.coalesce(F.max(quoted(period)).cast("string"), F.lit("")).alias("periodo"))


def reconcile(source: DataFrame, target: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row count and checksum of both sides, and whether they agree, in total or per ``by`` value.

    Both sides are aggregated before they meet.
    """
    by = by or []

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias(f"rows_{tag}"), checksum(df).alias(f"checksum_{tag}")
        )

    s, t = side(source, "source"), side(target, "destination")
    joined = s.join(t, by, "full_outer") if by else _side_by_side(s, t)
    numbers = [
        F.coalesce(F.col(c), F.lit(0)).alias(c)
        for c in ("rows_source", "rows_destination", "checksum_source", "checksum_destination")
    ]
    agree = (F.col("rows_source") == F.col("rows_destination")) & (
        F.col("checksum_source") == F.col("checksum_destination")
    )
    return joined.select(*by, *numbers).withColumn("reconciled", agree)


def _side_by_side(s: DataFrame, t: DataFrame) -> DataFrame:
    """Two one-row frames as one row, each value coming from the frame that has it."""
    both = s.unionByName(t, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
