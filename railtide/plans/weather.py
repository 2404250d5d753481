"""Weather upkeep: fallback chain, current snapshot, forecast slots and the watchdog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules
from railtide.operators import gapfill, nested
from railtide.session import cut_lineage
from railtide.sinks import tables
from railtide.sources import feeds

READINGS = gapfill.READINGS


def _stored(current: DataFrame) -> DataFrame:
    return current.select("station", *[F.col(v).alias(v + "_stored") for v in READINGS], F.lit(True).alias("has_stored"))


def _spread(df: DataFrame, weather: str) -> DataFrame:
    now = F.col(weather)["current"]
    return df.withColumns({
        "has_fresh": F.col(weather).isNotNull(), **{v: now[v] for v in READINGS}, "observed_at": now["observed_at"],
        "forecasts": F.col(weather)["forecasts"],
    }).drop(weather)


def refresh(stations: DataFrame, payloads: DataFrame, current: DataFrame, now: Column,
            days: int = vocab.FORECAST_DAYS, run: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(current rows, forecast rows) of a run over all stations.

    ``payloads`` has station, primary and secondary text.  A station without either takes over the
    whole reading, forecasts included, of the nearest earlier station in corridor order; then its
    own stored row; then the constants.  ``fallback_level`` says which.
    """
    group = [run] if run else []
    met = stations.join(payloads, [*group, "station"], "left")
    base = _spread(feeds.parse_weather(met, ("primary", "secondary"), feeds.local_hour(now), days, "_w"), "_w")
    carried = gapfill.fill_from_neighbours(base, group, "station_seq", [*READINGS, "observed_at", "forecasts"], F.col("has_fresh"))
    met = carried.join(_stored(current), "station", "left").withColumn("has_stored", F.coalesce("has_stored", F.lit(False)))
    filled = gapfill.fallback_chain(
        met, READINGS, [("fresh", F.col("has_fresh"), ""), ("neighbour", F.col("has_near"), "_near"), ("stored", F.col("has_stored"), "_stored")])
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    observed = (
        F.when(F.col("has_fresh"), F.col("observed_at")).when(F.col("has_near"), F.col("observed_at_near"))
        .when(F.col("has_stored"), stamp).otherwise(feeds.local_hour(now))
    )
    slots = F.when(F.col("has_fresh"), F.col("forecasts")).otherwise(F.col("forecasts_near"))
    ready = filled.withColumns({"observed_at": observed, "forecasts": slots})
    rows = ready.select(
        *group, "station", *[F.col(f"_f_{v}").alias(v) for v in READINGS],
        rules.rainfall_level(F.col("_f_rainfall_mm")).alias("computed_rainfall_level"), "observed_at",
        stamp.alias("fetched_at"), "fallback_level")
    forecasts = ready.select(*group, "station", "code", "fallback_level", F.posexplode("forecasts").alias("_pos", "f")).select(
        *group, nested.slot_id(F.col("code"), F.col("_pos") + 1).alias("id"), "station", "f.*",
        rules.rainfall_level(F.col("f.rainfall_sum_mm")).alias("computed_rainfall_level"), stamp.alias("fetched_at"), "fallback_level")
    return rows, forecasts


def watchdog(stations: DataFrame, current: DataFrame, payloads: DataFrame, now: Column,
             threshold: float = vocab.STALE_MINUTES) -> DataFrame:
    """Current rows for stale stations only: secondary source, then primary, then the constants."""
    seen = gapfill.last_seen(current, "station")
    stale = gapfill.audit_freshness(stations.select("station"), seen, "station", now, threshold).where("is_stale").select("station")
    met = stale.join(payloads, "station", "left")
    base = _spread(feeds.parse_weather(met, ("secondary", "primary"), feeds.local_hour(now), out="_w"), "_w")
    filled = gapfill.fallback_chain(base, READINGS, [("fresh", F.col("has_fresh"), "")])
    return filled.select(
        "station", *[F.col(f"_f_{v}").alias(v) for v in READINGS],
        rules.rainfall_level(F.col("_f_rainfall_mm")).alias("computed_rainfall_level"),
        F.coalesce("observed_at", feeds.local_hour(now)).alias("observed_at"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("fetched_at"), "fallback_level")


def _named(report: DataFrame, name: str) -> DataFrame:
    return report.select(F.lit(name).alias("table"), "matched", "unmatched")


def store_refresh(stations: DataFrame, payloads: DataFrame, current_path: str, forecasts_path: str, now: Column,
                  days: int = vocab.FORECAST_DAYS) -> DataFrame:
    """Refresh all stations and write both tables; returns (table, matched, unmatched).

    Stored rows are updated by station, forecast slots by (id, station); nothing is inserted, and what
    has no stored row is counted as unmatched.  Readings are written down before either table
    changes, so both get the same run, and a run can be repeated.
    """
    spark = stations.sparkSession
    current = tables.read_table(spark, current_path)
    if current is None:
        raise ValueError(f"{current_path} holds no table to update")
    rows, forecasts = (cut_lineage(df) for df in refresh(stations, payloads, current, now, days))
    seen = tables.load_update_only(rows, current_path, ["station"])
    slots = tables.load_update_only(forecasts, forecasts_path, ["id", "station"])
    return _named(seen, "current").unionByName(_named(slots, "forecasts"))


def store_watchdog(stations: DataFrame, payloads: DataFrame, current_path: str, now: Column,
                   threshold: float = vocab.STALE_MINUTES) -> DataFrame:
    """Update the stored rows of stale stations; returns (table, matched, unmatched)."""
    current = tables.read_table(stations.sparkSession, current_path)
    if current is None:
        raise ValueError(f"{current_path} holds no table to update")
    rows = cut_lineage(watchdog(stations, current, payloads, now, threshold))
    return _named(tables.load_update_only(rows, current_path, ["station"]), "current")
