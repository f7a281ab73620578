"""Column expressions for loosely typed parameters and local time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..contracts import FALSE_WORDS, LOCAL_ZONE, TRUE_WORDS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """NULL, or text with nothing but spaces."""
    c = _col(c).cast("string")
    return c.isNull() | (F.trim(c) == "")


def loose_bool(c: Column | str, default: bool) -> Column:
    word = F.lower(F.trim(_col(c).cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(F.lit(default))


def loose_int(c: Column | str, default: int) -> Column:
    text = F.trim(_col(c).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text)
    return F.coalesce(whole.try_cast("int"), F.lit(default).cast("int"))


def reader_options(c: Column | str) -> Column:
    """JSON text to ext -> (option -> value). Blank is an empty map, bad JSON is NULL."""
    c = _col(c).cast("string")
    empty = F.from_json(F.lit("{}"), "map<string,map<string,string>>")
    return F.when(blank(c), empty).otherwise(F.from_json(c, "map<string,map<string,string>>"))


def local_time(c: Column | str, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(_col(c), zone)
