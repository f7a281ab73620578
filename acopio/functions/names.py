"""Column expressions over file paths. All run inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..contracts import COMPRESSION_SUFFIXES, FILE_TYPES
from .values import _col

_COMPRESSED = "(" + "|".join(re.escape(s) for s in COMPRESSION_SUFFIXES) + ")$"


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_col(path), r"([^/]+)$", 1)


def file_type(path: Column | str) -> Column:
    """excel/csv/txt/json/parquet/unknown, looking through one compression suffix."""
    plain = F.regexp_replace(F.lower(_col(path)), _COMPRESSED, "")
    kind = F.lit("unknown")
    for name, suffixes in reversed(FILE_TYPES.items()):
        hit = F.lit(False)
        for suffix in suffixes:
            hit = hit | plain.endswith(suffix)
        kind = F.when(hit, F.lit(name)).otherwise(kind)
    return kind


def dataset_name(path: Column | str) -> Column:
    """Logical dataset: file name up to the first dot, then up to the first underscore."""
    stem = F.split_part(F.element_at(F.split(_col(path), "/"), -1), F.lit("."), F.lit(1))
    return F.split_part(stem, F.lit("_"), F.lit(1))


def relative_path(path: Column | str, root: str) -> Column:
    return F.ltrim(F.substr(_col(path), F.lit(len(root) + 1)), F.lit("/"))


def batch_id(run_id: str, path: Column | str) -> Column:
    """One id per file and run; the same again if a task is re-run."""
    return F.md5(F.concat(F.lit(run_id), F.lit("\x1f"), _col(path)))


def metadata_path() -> Column:
    """``_metadata.file_path`` in the plain form file listings use (it arrives URL-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
