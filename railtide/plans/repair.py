"""Repair pass over a stored event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.functions import rules, text
from railtide.operators import dedupe, ids


def repair_events(events: DataFrame, tie: str = "id") -> DataFrame:
    """Drop later copies, recategorise, clear false cancellations and renumber each category.

    The oldest row of each text prefix stays; rows without text all stay.  New numbers follow the
    old ones, ties the time of scraping.
    """
    keyed = events.withColumn("_key", text.raw_text_key(F.col("post_text"), F.col("image_text")))
    kept = dedupe.keep_first_or_blank(keyed, "_key", ["scraped_at", tie]).drop("_key")
    code, clear = rules.repair_flags(F.col("event_name"), F.col("event_code"))
    fixed = kept.withColumns({
        "category": rules.repaired_category(F.col("source_name"), F.col("event_name")),
        "event_code": code,
        "is_cancellation": F.col("is_cancellation") & ~clear,
        "cancellation_target_code": F.when(~clear, F.col("cancellation_target_code")),
        "_old": rules.id_number(F.col("id")),
    })
    numbered = ids.number_within(fixed, ["category"], ["_old", "scraped_at", tie], "_n")
    new_id = ids.padded_id(F.concat(F.lit("external_"), F.col("category")), F.col("_n"), "_")
    return numbered.withColumn("id", new_id).drop("_old", "_n")
