"""Words and sizes of texts, as column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words: the space and the characters 9 to 13.
SPACES = "[\\x20\\x09-\\x0D]+"
EDGES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text in order; none for a null, empty or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def hash_bucket(digest: Column, first: int, digits: int) -> Column:
    """Hex digits of a digest as a number; SQL engines that share md5 share the buckets."""
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")
