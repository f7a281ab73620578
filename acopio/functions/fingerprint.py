"""Row fingerprints and order-insensitive checksums."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..contracts import CONTROL_COLUMNS, READ_PARTITION_COLUMN

SEPARATOR = "\x1f"
ESCAPE = "\x1e"

# A fingerprint must describe the business row only: columns that change with
# every load would make each row look changed.
_NOT_FINGERPRINTED = {
    c.lower()
    for c in (*CONTROL_COLUMNS, READ_PARTITION_COLUMN, "batch_id", "ingestion_ts", "nombre_archivo")
}


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fingerprint_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = _NOT_FINGERPRINTED | {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in skip]


def _text(field: T.StructField) -> Column:
    """A value as text in which separator, escape and NULL cannot be confused."""
    text = quoted(field.name).cast("string")
    if not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e"))
        text = F.replace(text, F.lit(SEPARATOR), F.lit(ESCAPE + "s"))
    return F.coalesce(text, F.lit(ESCAPE + "0"))


def row_text(df: DataFrame, columns: Iterable[str] | None = None, legacy: bool = False) -> Column:
    """The text a fingerprint is taken of.

    ``legacy`` glues the values together with nothing between them and NULL as
    empty text, for comparison with tables that were written that way.
    """
    names = list(columns) if columns is not None else fingerprint_columns(df)
    fields = [df.schema[n] for n in names]
    if legacy:
        return F.concat(*[F.coalesce(quoted(f.name).cast("string"), F.lit("")) for f in fields])
    return F.concat_ws(SEPARATOR, *[_text(f) for f in fields])


def row_hash(df: DataFrame, columns: Iterable[str] | None = None, legacy: bool = False) -> Column:
    return F.hash(row_text(df, columns, legacy))


def row_md5(df: DataFrame, columns: Iterable[str] | None = None, legacy: bool = False) -> Column:
    return F.md5(row_text(df, columns, legacy))


def md5_word(md5: Column | str) -> Column:
    """First 32 bits of an md5 text as a number."""
    md5 = F.col(md5) if isinstance(md5, str) else md5
    return F.conv(F.substring(md5, 1, 8), 16, 10).cast("bigint")


def wrapping_sum(value: Column) -> Column:
    """Sum of a 32-bit number over any row count, as bigint, 0 for no rows.

    The two halves are summed apart so that neither can overflow, and joined
    once at the end; beyond 64 bits the result wraps instead of failing.
    """
    value = value.cast("bigint")
    high = F.coalesce(F.sum(F.shiftright(value, 16)), F.lit(0)).cast("decimal(38,0)")
    low = F.coalesce(F.sum(value.bitwiseAND(F.lit(65535))), F.lit(0)).cast("decimal(38,0)")
    total = (high * F.lit(65536).cast("decimal(6,0)") + low).cast("decimal(38,0)")
    span = F.lit("18446744073709551616").cast("decimal(20,0)")
    half = F.lit("9223372036854775808").cast("decimal(19,0)")
    wrapped = (F.pmod(total + half, span) - half).cast("decimal(38,0)")
    return wrapped.cast("bigint")


def checksum(df: DataFrame, columns: Iterable[str] | None = None, legacy: bool = False) -> Column:
    """Aggregate: sum of row hashes, using a stored ``ingesta_hash`` when there is one."""
    stored = next((c for c in df.columns if c.lower() == "ingesta_hash"), None)
    return wrapping_sum(quoted(stored) if stored else row_hash(df, columns, legacy))
