"""Insert, update and delete rows between two snapshots of a stock table.

Most rows of a snapshot do not change, so the comparison is done on (key,
fingerprint) alone and full rows are fetched only for the keys that changed.
Each side is folded to one row per key before it is joined: a repeated key
costs one row, never all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contracts import OP_DELETE, OP_INSERT, OP_NONE, OP_UPDATE
from ..functions import fingerprint_columns, row_md5
from ..session import stage

OPERATION = "sdelta_operacion"
COMPARED_PERIOD = "sdelta_periodo_compararacion"
NO_FINGERPRINT = "-"


def _with_fingerprint(df: DataFrame, fingerprint: str, described: list[str]) -> DataFrame:
    """The frame with its fingerprint; computed here when it is not stored."""
    if fingerprint.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(fingerprint, row_md5(df, described))


def _fp(fingerprint: str) -> Column:
    return F.coalesce(F.col(fingerprint), F.lit(NO_FINGERPRINT))


def _per_key(df: DataFrame, key: str, fingerprint: str, side: str) -> DataFrame:
    described = fingerprint_columns(df)
    return (
        _with_fingerprint(df.where(F.col(key).isNotNull()), fingerprint, described)
        .select(F.col(key).alias("_key"), _fp(fingerprint).alias("_fp"))
        .groupBy("_key")
        .agg(F.min("_fp").alias(f"_{side}_low"), F.max("_fp").alias(f"_{side}_high"))
    )


def changed_keys(new: DataFrame, old: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """``_key, _op, _old_low, _old_high`` for keys on one side only or with differing fingerprints."""
    n = _per_key(new, key, fingerprint, "new")
    o = _per_key(old, key, fingerprint, "old")
    op = (
        F.when(F.col("_old_low").isNull(), F.lit(OP_INSERT))
        .when(F.col("_new_low").isNull(), F.lit(OP_DELETE))
        .otherwise(F.lit(OP_UPDATE))
    )
    same = (
        F.col("_new_low").eqNullSafe(F.col("_old_low"))
        & F.col("_new_high").eqNullSafe(F.col("_old_high"))
        & F.col("_new_low").eqNullSafe(F.col("_new_high"))
    )
    return n.join(o, "_key", "full_outer").where(~same).select("_key", op.alias("_op"), "_old_low", "_old_high")


def snapshot_delta(
    new: DataFrame,
    old: DataFrame,
    *,
    key: str = "SDELTA_ID",
    fingerprint: str = "ingesta_md5",
    new_period: str = "",
    old_period: str = "",
    period_column: str | None = "periodo",
    staged: bool = True,
) -> DataFrame:
    """Change rows from ``old`` to ``new``, tagged I, U or D; '-' for rows without a key.

    Inserted and updated rows carry the new values, deleted rows the old ones.
    Columns of either side are kept, NULL where a side lacks them. A new row is
    given once, however many old rows share its key. Nothing is compared when
    the new period lies before the old one.

    A side without the fingerprint column gets it from its own columns.

    ``staged`` writes the changed keys to the shared folder first. Their true
    size is then known when the full rows are joined to them, and a small change
    set is broadcast without shuffling either snapshot.
    """
    if new_period < old_period:
        new, old = new.limit(0), old.limit(0)
    changed = changed_keys(new, old, key, fingerprint)
    if staged:
        changed = stage(changed, "snapshot-keys")

    def printed(df: DataFrame, described: DataFrame) -> DataFrame:
        return _with_fingerprint(df, fingerprint, fingerprint_columns(described))

    # fingerprints that are not stored are worked out after the join, for changed keys only
    has_fp = _fp(fingerprint) != NO_FINGERPRINT
    incoming = changed.where(F.col("_op") != OP_DELETE)
    low, high = (F.coalesce(F.col(c), F.lit(NO_FINGERPRINT)) for c in ("_old_low", "_old_high"))
    fetched = printed(new.join(incoming, new[key] == incoming["_key"], "inner"), new)
    written = fetched.where((_fp(fingerprint) != low) | (_fp(fingerprint) != high)).withColumn(OPERATION, F.col("_op"))
    written = written.drop(*changed.columns)
    # '-' sorts before any fingerprint: a key's lowest one tells whether a row of it lacks one
    gone = changed.where(F.col("_op") == OP_DELETE).select("_key", (F.col("_old_low") == NO_FINGERPRINT).alias("_bare"))
    dropped = printed(old.join(gone, old[key] == gone["_key"], "inner"), old)
    removed = dropped.where(~F.col("_bare") | has_fp).withColumn(OPERATION, F.lit(OP_DELETE)).drop("_key", "_bare")
    keyless_new, keyless_old = (
        printed(df.where(F.col(key).isNull()), df).where(has_fp).withColumn(OPERATION, F.lit(OP_NONE)) for df in (new, old)
    )

    new_side = written.unionByName(keyless_new)
    old_side = removed.unionByName(keyless_old)
    new_side, old_side = _same_types(new_side, old_side)
    delta = new_side.unionByName(old_side, allowMissingColumns=True)
    return _tag(delta, old_period, new_period, period_column)


def first_delta(new: DataFrame) -> DataFrame:
    """The change rows of a first load: every row inserted, nothing compared against."""
    return new.select("*", F.lit(OP_INSERT).alias(OPERATION), F.lit("").alias(COMPARED_PERIOD))


def apply_delta(old: DataFrame, delta: DataFrame, *, key: str = "SDELTA_ID") -> DataFrame:
    """The new snapshot: old rows that were not touched, and the inserted and updated rows."""
    kept = old.join(delta.select(key).distinct(), key, "left_anti")
    written = delta.where(F.col(OPERATION).isin(OP_INSERT, OP_UPDATE)).drop(OPERATION, COMPARED_PERIOD)
    return kept.unionByName(written, allowMissingColumns=True)


def _same_types(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A column both sides have with different types is compared and kept as text."""
    types = {f.name.lower(): f.dataType for f in right.schema}
    clash = {
        f.name.lower() for f in left.schema if f.name.lower() in types and types[f.name.lower()] != f.dataType
    }

    def as_text(df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(f"`{c}`").cast("string").alias(c) if c.lower() in clash else F.col(f"`{c}`") for c in df.columns]
        )

    return (as_text(left), as_text(right)) if clash else (left, right)


def _tag(delta: DataFrame, old_period: str, new_period: str, period_column: str | None) -> DataFrame:
    tagged = delta.withColumn(COMPARED_PERIOD, F.lit(old_period))
    return tagged.withColumn(period_column, F.lit(new_period)) if period_column else tagged
