"""Conflict policies of incremental loads, as joins of the stored and the new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_if_absent(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows whose key is not stored (append these)."""
    return new.join(stored.select(*key), list(key), "left_anti")


def insert_or_touch(stored: DataFrame, new: DataFrame, key: Sequence[str], stamp: str, now: Column) -> DataFrame:
    """Stored values win; a key seen again only gets a fresh time stamp.

    Columns that one side lacks are NULL there, so the table grows with its sources.
    """
    columns = list(dict.fromkeys([*stored.columns, *new.columns]))
    old, fresh = stored.alias("o"), new.alias("n")
    both = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key]
    had, has = F.col(f"o.{key[0]}").isNotNull(), F.col(f"n.{key[0]}").isNotNull()

    def pick(name: str) -> Column:
        if name == stamp:
            return F.when(has, now).otherwise(F.col(f"o.{stamp}"))
        if name not in stored.columns:
            return F.when(~had, F.col(f"n.{name}"))
        if name not in new.columns:
            return F.col(f"o.{name}")
        return F.when(had, F.col(f"o.{name}")).otherwise(F.col(f"n.{name}"))

    return old.join(fresh, both, "full").select(*[pick(c).alias(c) for c in columns])


def upsert(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows replace stored rows of the same key as a whole."""
    kept = stored.join(new.select(*key).distinct(), list(key), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def update_only(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows with the columns of a matching new row; nothing is inserted.

    Adds ``was_updated``.  ``new`` has one row per key.
    """
    values = [c for c in new.columns if c not in key]
    fresh = new.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(v).alias(f"_n_{v}") for v in values])
    met = stored.join(fresh, [F.col(k) == F.col(f"_k_{k}") for k in key], "left")
    hit = F.col(f"_k_{key[0]}").isNotNull()
    return met.select(
        *[F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in stored.columns],
        hit.alias("was_updated"),
    )


def update_report(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many new rows met a stored row and how many did not."""
    known = stored.select(*key).distinct().withColumn("_known", F.lit(True))
    return new.join(known, list(key), "left").agg(
        F.count_if(F.col("_known").isNotNull()).alias("matched"),
        F.count_if(F.col("_known").isNull()).alias("unmatched"),
    )
