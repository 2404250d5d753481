"""Calendar releases of schools: filter, read images on a hint, number, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import labels, rules, text, times
from railtide.operators import dedupe, ids, match
from railtide.plans.posts import EVENT_COLUMNS, Extractor, read_images
from railtide.session import cut_lineage
from railtide.sinks import tables
from railtide.sources import state


def school_pages(pages: DataFrame, excluded=tuple(vocab.CALENDAR_EXCLUDED_SOURCES)) -> DataFrame:
    return pages.where(~text.contains_any(F.lower("name"), excluded))


def find_calendars(items: DataFrame, pages: DataFrame, ledger: DataFrame | None, stored: DataFrame | None, now: Column,
                   extract: Extractor | None = None, max_age: float = vocab.CALENDAR_MAX_AGE_DAYS,
                   unmatched: str = "quarantine") -> DataFrame:
    """New calendar releases as event rows.

    Captions that do not pass but hint at a calendar get their images read, within a budget per
    page; the joined text is then tested again.
    """
    schools = school_pages(pages)
    placed = match.assign_pages(items, schools, unmatched=unmatched).where("page_seq is not null")
    if ledger is not None:
        placed = dedupe.drop_held(placed, ledger.select(F.col("url").alias("source_url")), "source_url")
    page = schools.select("page_seq", "station", F.col("name").alias("source_name"), F.col("url").alias("page_url"))
    aged = placed.withColumn("age_days", times.age_days(now, F.col("posted_at"))).where(times.within_age(F.col("age_days"), max_age))
    posts = aged.join(page, "page_seq").withColumn("text", text.clean_caption(F.col("raw_text")))
    posts = posts.withColumn("_folded", rules.folded(F.col("text")))
    folded = F.col("_folded")
    special = F.lower("page_url").contains(vocab.BRANCH_SOURCE_TOKEN) | F.lower("source_name").contains(vocab.BRANCH_SOURCE_TOKEN)
    concerned = rules.concerns_branch(folded, systemwide=vocab.CALENDAR_BRANCH_SYSTEMWIDE, exception=vocab.CALENDAR_BRANCH_EXCEPTION)
    posts = posts.where(~special | concerned).withColumns({
        "_valid": rules.is_calendar_release(folded), "_hint": rules.has_calendar_hint(folded),
    })
    posts = cut_lineage(posts.where("_valid or _hint").drop("_folded"))
    hinted = read_images(posts.where("not _valid"), "page_seq", ["page_seq", "item_seq"], extract, vocab.CALENDAR_EXTRACTIONS_PER_PAGE)
    passed = hinted.where(rules.is_calendar_release(rules.folded(text.joined_text(F.col("text"), F.col("image_text")))))
    found = posts.where("_valid").withColumn("image_text", F.lit("")).unionByName(passed)
    once = dedupe.keep_first(found, ["source_url"], ["page_seq", "item_seq"])
    return shape_calendars(once, stored, now)


def shape_calendars(found: DataFrame, stored: DataFrame | None, now: Column) -> DataFrame:
    numbered = ids.number_rows(found, ["page_seq", "item_seq"], "_n")
    last = 0
    if stored is not None:
        last = ids.next_number(stored, "id", "external_acad_cal").first()["next_number"] - 1
    event = F.concat(F.lit(f"Academic Calendar {vocab.CALENDAR_YEAR_LABEL} — "), labels.acronym(F.col("source_name")))
    none = F.lit(None).cast("string")
    return numbered.select(
        ids.padded_id(F.lit("external_acad_cal"), F.col("_n") + last, "_").alias("id"), "station", "source_name", "source_url",
        text.cap(F.col("text"), vocab.POST_TEXT_CHARS).alias("post_text"),
        F.nullif(text.cap(F.col("image_text"), vocab.IMAGE_TEXT_CHARS), F.lit("")).alias("image_text"),
        F.lit("academic_calendar").alias("category"), event.alias("event_name"),
        F.lit(vocab.CALENDAR_YEAR_LABEL).alias("event_date"), none.alias("event_code"), F.lit(False).alias("is_cancellation"),
        none.alias("cancellation_target_code"), now.alias("scraped_at"), times.post_date(now, F.col("posted_at")).alias("post_date"),
    ).select(*EVENT_COLUMNS)


def store_calendars(items: DataFrame, pages: DataFrame, events_path: str, ledger_path: str, export_path: str, now: Column,
                    **options) -> DataFrame:
    """Find new releases, upsert them, export them per school and enter their URLs in the ledger; returns what was exported.

    A release is new while neither ledger nor stored events hold its URL.  Exported is what is stored
    but not in the ledger, so a run that broke off after the upsert is completed by the next one, and
    only one that broke off between export and ledger exports its rows again.
    """
    spark = items.sparkSession
    ledger, stored = cut_lineage(state.read_ledger(spark, ledger_path)), tables.read_table(spark, events_path)
    known = ledger if stored is None else ledger.unionByName(stored.select(F.col("source_url").alias("url")))
    found = cut_lineage(find_calendars(items, pages, known, stored, now, **options))
    held = tables.load_upsert(found, events_path, ["id"])
    releases = held.where(F.col("id").startswith("external_acad_cal_"))
    pending = cut_lineage(dedupe.drop_held(releases, ledger.select(F.col("url").alias("source_url")), "source_url"))
    tables.export_calendars(pending, export_path)
    tables.append_ledger(pending.select(F.col("source_url").alias("url")), ledger_path)
    return pending
