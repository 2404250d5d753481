"""Fallback chains with provenance, last-seen state and freshness audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import times
from railtide.operators.scan import carry_forward

READINGS = list(vocab.BASELINE_WEATHER)


def fill_from_neighbours(df: DataFrame, group: Sequence[str], order: str, values: Sequence[str],
                         valid: Column, chunk: Column | None = None, suffix: str = "_near", **options) -> DataFrame:
    """Add for each value the reading of the nearest earlier valid row along ``order``.

    The whole reading moves together: a missing field of a valid row is not patched from elsewhere.
    ``options`` go to ``carry_forward``.
    """
    packed = F.when(valid, F.struct(*[F.col(v).alias(v) for v in values]))
    carried = carry_forward(df, group, order, {"_near": packed}, chunk, **options)
    return carried.select(*df.columns, *[F.col(f"_near.{v}").alias(v + suffix) for v in values],
                          F.col("_near").isNotNull().alias("has" + suffix))


def fallback_chain(df: DataFrame, values: Sequence[str], sources: Sequence[tuple[str, Column, str]],
                   constants: Mapping[str, float] = vocab.BASELINE_WEATHER) -> DataFrame:
    """Take each reading as a whole from the first source that has one, and say which it was.

    ``sources`` are (label, condition, column suffix); the constants come last.  A stored reading
    that lacks a field gets that field's constant.
    """
    level = F.lit("constant")
    for label, has, _ in reversed(sources):
        level = F.when(has, F.lit(label)).otherwise(level)
    filled = {}
    for v in values:
        out = F.lit(constants[v])
        for _, has, suffix in reversed(sources):
            out = F.when(has, F.coalesce(F.col(v + suffix), F.lit(constants[v]))).otherwise(out)
        filled[v] = out
    return df.withColumn("fallback_level", level).withColumns({f"_f_{v}": c for v, c in filled.items()})


def take_filled(df: DataFrame, keep: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[F.col(f"_f_{v}").alias(v) for v in values], "fallback_level")


def last_seen(readings: DataFrame, key: str, fetched: str = "fetched_at", observed: str = "observed_at",
              order: str | None = None) -> DataFrame:
    """Latest report per key; unreadable times do not count.

    With ``order`` the last row wins, otherwise the latest time.
    """
    def read(name: str) -> Column:
        column = F.col(name)
        return F.try_to_timestamp(column) if dict(readings.dtypes)[name] == "string" else column.cast("timestamp")

    first = F.col(fetched)
    blank = first.isNull() | (first.cast("string") == "")
    seen = F.when(blank, read(observed)).otherwise(read(fetched))
    by = F.when(seen.isNotNull(), F.col(order)) if order else seen
    return readings.groupBy(key).agg(F.max_by(seen, by).alias("last_seen"))


def audit_freshness(members: DataFrame, seen: DataFrame, key: str, now: Column,
                    threshold: float = vocab.STALE_MINUTES) -> DataFrame:
    """Every member with its age in minutes; members never seen are stale."""
    return members.join(seen, key, "left").withColumns({
        "age_minutes": times.stale_minutes(now, F.col("last_seen")),
        "is_stale": times.is_stale(now, F.col("last_seen"), threshold),
    })


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current snapshot: the latest row of each key, combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    packed = df.groupBy(*key).agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return packed.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


__all__ = [
    "READINGS", "audit_freshness", "fallback_chain", "fill_from_neighbours", "last_seen",
    "latest_per_key", "take_filled",
]
