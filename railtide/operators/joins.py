"""Joins against a side with one row per key, for keys that may be hot on the other side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_left_join(left: DataFrame, unique: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a side that is unique on ``on``; NULL keys meet.

    Nothing is copied or hinted: the adaptive plan broadcasts a side it has measured as small and
    splits the partition of a hot key on the left otherwise.
    """
    for key in on:
        unique = unique.withColumnRenamed(key, f"_u_{key}")
    added = [c for c in unique.columns if not c.startswith("_u_")]
    same = [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in on]
    return left.join(unique, same, "left").select(*left.columns, *added)


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """NOT EXISTS on equal keys.  A hot key on the left is split by the adaptive skew join."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")
