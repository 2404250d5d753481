"""Words of a text as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BREAK = r"[^\p{L}\p{N}]+"


def words_column(text: Column) -> Column:
    """Lower-cased runs of letters and digits; NULL has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), BREAK)
    return F.filter(parts, lambda w: w != "")


def hashed(words: Column) -> Column:
    """64-bit hashes of an array of words."""
    return F.transform(words, lambda w: F.xxhash64(w))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
