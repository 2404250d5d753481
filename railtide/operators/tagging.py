"""Event codes, friction weights, cancellations and digests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules, times
from railtide.functions.keywords import group_mask, groups_found, in_mask
from railtide.operators.joins import unique_left_join


def tag_events(df: DataFrame, folded: Column, code_rules=vocab.EVENT_CODE_RULES, cancel_words=vocab.CANCEL_WORDS,
               quiet_words=vocab.NON_DISRUPTIVE_WORDS) -> DataFrame:
    """Add event_code, is_cancellation, cancellation_target_code and affects_ridership.

    The words of all rules are looked up in one pass; every decision reads the same mask.
    """
    groups = {**rules.code_groups(code_rules), **rules.cancel_groups(cancel_words), "quiet": quiet_words}
    found = in_mask(F.col("_found_groups"), groups)
    out = df.withColumn("_found_groups", group_mask(folded, groups))
    out = out.withColumn("event_code", rules.event_code(None, code_rules, found))
    out = out.withColumn("is_cancellation", rules.is_cancellation(None, F.col("event_code"), found=found))
    return out.withColumns({
        "cancellation_target_code": rules.cancellation_target(F.col("event_code"), F.col("is_cancellation")),
        "affects_ridership": rules.affects_ridership(None, F.col("event_code"), found=found),
    }).drop("_found_groups")


def friction_weight(folded: Column, words: Mapping[str, Sequence[str]] = vocab.FRICTION_GROUP_WORDS,
                    weights: Mapping[str, float] = vocab.GROUP_FRICTION) -> Column:
    """Largest weight among the keyword groups that occur; NULL if none does."""
    hits = [F.when(has, F.lit(float(weights[g]))) for g, has in groups_found(folded, words).items()]
    return F.greatest(*hits) if len(hits) > 1 else hits[0]


def friction_by_hit(hits: DataFrame, weights: DataFrame, group: str = "keyword_group", key: str = "post_id") -> DataFrame:
    """Weight table join: the largest weight of the groups each post hit."""
    return hits.join(weights, group).groupBy(key).agg(F.max("weight").alias("friction_weight"))


def cancel_earlier(events: DataFrame, source: str = "source_name", code: str = "event_code",
                   target: str = "cancellation_target_code", at: str = "post_date",
                   cancels: str = "is_cancellation") -> DataFrame:
    """Add ``is_active``: false once the same source later cancels that code.

    Only the latest cancellation of a (source, code) matters, so the other side of the join has one
    row per key and pairs of events are never built.
    """
    lifted = (
        events.where(F.col(cancels) & F.col(target).isNotNull())
        .groupBy(source, F.col(target).alias(code)).agg(F.max(at).alias("_lifted_at"))
    )
    met = unique_left_join(events, lifted, [source, code])
    dead = ~F.col(cancels) & (F.col(at) < F.col("_lifted_at"))
    return met.withColumn("is_active", ~F.coalesce(dead, F.lit(False))).select(*events.columns, "is_active")


def digest_rows(events: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Readable rows of newly saved events."""
    given = {c: c for c in ("source_name", "station", "batch", "category", "event_name", "event_date", "url")}
    given.update(columns or {})
    return events.select(
        F.col(given["source_name"]).alias("source_name"),
        F.coalesce(F.col(given["station"]), F.lit("N/A")).alias("station"),
        F.coalesce(F.nullif(F.col(given["batch"]), F.lit("")), F.lit("N/A")).alias("batch"),
        rules.category_label(F.col(given["category"])).alias("category"),
        F.coalesce(F.nullif(F.col(given["event_name"]), F.lit("")), F.lit("N/A")).alias("event_name"),
        times.pretty_event_date(F.col(given["event_date"])).alias("event_date"),
        F.col(given["url"]).alias("url"),
    )


def digest_counts(events: DataFrame, keys: Sequence[str] = ("batch", "category")) -> DataFrame:
    return events.groupBy(*keys).agg(F.count("*").alias("new_events"))
