"""Announcement posts: assign, clean, gate, classify, dedupe against the state, number."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules, text, times, urls
from railtide.operators import dedupe, ids, match, nested, tagging, topk
from railtide.operators.joins import unique_left_join
from railtide.session import cut_lineage
from railtide.sinks import tables
from railtide.sources import state

EVENT_COLUMNS = [
    "id", "station", "source_name", "source_url", "post_text", "image_text", "category", "event_name",
    "event_date", "event_code", "is_cancellation", "cancellation_target_code", "scraped_at", "post_date",
]
ANSWER_COLUMNS = [
    "answer_category", "event_name", "event_date", "event_code", "is_cancellation",
    "cancellation_target_code", "answer_failed",
]
Extractor = Callable[[DataFrame], DataFrame]
Classifier = Callable[[DataFrame], DataFrame]


@dataclass
class PostRun:
    """New events, and how many posts each stage let through."""

    events: DataFrame
    summary: DataFrame


def read_images(posts: DataFrame, group: str, order: list[str], extract: Extractor | None = None,
                budget: int = vocab.EXTRACTIONS_PER_PAGE, media: str = "media") -> DataFrame:
    """Add ``image_text`` to posts with a unique ``item_seq``.

    Images are read in post order, at most ``budget`` per page, and each address once.  Where no
    extractor is given or it finds nothing, the text that came with the image is cleaned instead.
    """
    entries = posts.select(group, *[o for o in order if o != group], F.posexplode(media).alias("media_pos", "m"))
    entries = entries.withColumns({
        "uri": nested.media_uri(F.col("m")), "supplied": text.clean_ocr(F.coalesce(F.col("m.ocrText"), F.lit(""))),
    }).where("uri is not null").drop("m")
    if extract is None:
        read = entries.withColumn("extracted", F.lit(None).cast("string"))
    else:
        chosen = topk.budget(entries, [group], [*order, "media_pos"], budget)
        inside = chosen.withColumn("_ask", F.when(F.col("within_budget"), F.col("uri")))
        read = dedupe.once_per_value(
            inside, "_ask", lambda d: extract(d.withColumnRenamed("_ask", "uri")).withColumnRenamed("uri", "_ask"), "extracted")
    found = F.coalesce(F.nullif(F.col("extracted"), F.lit("")), F.col("supplied"))
    # a post's own media list, so the collected array is as long as that list
    texts = read.select("item_seq", "media_pos", F.nullif(found, F.lit("")).alias("t")).where("t is not null").groupBy("item_seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("media_pos", "t"))), lambda s: s["t"]), " ").alias("image_text"))
    return posts.join(texts, "item_seq", "left").withColumn("image_text", F.coalesce("image_text", F.lit("")))


def rule_classifier(posts: DataFrame) -> DataFrame:
    """Answers from the rule tables: code words, the text as a name, the latest date named."""
    folded = F.col("_folded")
    tagged = tagging.tag_events(posts, folded)
    whole = text.squash(F.concat_ws(" ", "text", "image_text"))
    dates = F.regexp_extract_all(whole, F.lit(times.ISO_DATE), 1)
    # a date that no calendar has is passed over
    real = F.filter(dates, lambda d: d.try_cast("date").isNotNull())
    quiet = ~tagging.rules.affects_ridership(folded, F.coalesce("event_code", F.lit("")))
    return tagged.withColumns({
        "answer_category": F.when(~quiet, F.col("_gate")),
        "event_name": whole,
        "event_date": F.array_max(real),
        "answer_failed": F.lit(False),
    }).drop("affects_ridership")


def answers_from_text(answers: Column) -> dict[str, Column]:
    """Columns of a classifier that returned JSON text; NULL or unreadable text means it failed."""
    parsed = nested.parse_answer(answers)
    return {
        "answer_category": parsed["category"], "event_name": parsed["event_name"], "event_date": parsed["event_date"],
        "event_code": parsed["event_code"], "is_cancellation": parsed["is_cancellation"],
        "cancellation_target_code": parsed["cancellation_target_code"],
        "answer_failed": answers.isNull(),
    }


def classify_once(posts: DataFrame, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a text classifier once per distinct (text, image_text).

    ``ask`` gets (key, text, image_text) and returns (key, answer) with JSON text.  Rows meet on a
    digest, so long texts are not join keys.
    """
    keyed = posts.withColumn("_key", F.sha2(F.to_json(F.struct("text", "image_text")), 256))
    inputs = keyed.groupBy(F.col("_key").alias("key")).agg(
        F.any_value("text").alias("text"), F.any_value("image_text").alias("image_text"))
    answers = ask(inputs).select(F.col("key").alias("_key"), "answer")
    return keyed.join(answers, "_key", "left").withColumns(answers_from_text(F.col("answer"))).drop("_key", "answer")


def page_posts(items: DataFrame, pages: DataFrame, mode: str, now: Column, extract: Extractor | None = None,
               batch: str = "all", unmatched: str = "quarantine", keep_newest: bool = True) -> DataFrame:
    """Cleaned posts of each page: young enough, within the page's limit, one per text.

    ``items`` are ``feeds.post_items`` rows with a unique BIGINT ``item_seq``.
    """
    limits, max_age = topk.sweep_limits(mode)
    chosen = topk.in_batches(pages, batch)
    # only keys are placed, ranked and counted; texts and media meet the posts that are left
    keys = items.select("item_seq", "asked_url", "page_name", "posted_at")
    placed = match.assign_pages(keys, chosen, unmatched=unmatched).where("page_seq is not null")
    aged = placed.withColumn("age_days", times.age_days(now, F.col("posted_at")))
    young = aged.where(times.within_age(F.col("age_days"), max_age)).select("item_seq", "posted_at", "page_seq", "matched_by", "age_days")
    page = chosen.select(
        "page_seq", "station", F.col("name").alias("source_name"), "source_type", "tier", F.col("batch"), F.col("url").alias("page_url"))
    newest = [F.desc_nulls_last("posted_at"), F.col("item_seq")]
    if keep_newest:
        # the largest limit goes before the join, so that a page with most posts meets in no task
        young = topk.first_n(young, ["page_seq"], newest, max(limits.values()))
    on_page = young.join(page, "page_seq")
    if keep_newest:
        on_page = topk.first_n_by_tier(on_page, ["page_seq"], newest, F.col("tier"), limits).drop("rank")
    on_page = items.join(on_page.drop("posted_at"), "item_seq")
    read = read_images(on_page, "page_seq", ["page_seq", "item_seq"], extract)
    cleaned = read.withColumns({"text": text.clean_caption(F.col("raw_text")), "image_text": text.strip(F.col("image_text"))})
    filled = cleaned.where((F.length("text") > 0) | (F.length("image_text") > 0)).withColumns({
        "text": F.when(F.col("text") == "", F.lit(vocab.PLACEHOLDER_CAPTION)).otherwise(F.col("text")),
        "source_url": F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.col("page_url")),
    })
    return dedupe.keep_first(filled, ["page_seq", "text", "image_text"], ["item_seq"])


def gate_posts(posts: DataFrame, now: Column, mode: str, stored: DataFrame | None, keep_params=None,
               branch_token: str = vocab.BRANCH_SOURCE_TOKEN, groups=rules.DEFAULT_GROUPS) -> DataFrame:
    """Posts that pass age, stored keys, branch and keyword tests; adds the dedupe keys."""
    _, max_age = topk.sweep_limits(mode)
    url_key = urls.url_key(F.col("source_url")) if keep_params is None else urls.url_key(F.col("source_url"), keep_params)
    joined = text.joined_text(F.col("text"), F.col("image_text"))
    keyed = posts.withColumns({
        "url_key": url_key, "text_key": text.text_key(F.col("text"), F.col("image_text")), "_folded": rules.folded(joined),
    }).where(times.within_age(F.col("age_days"), max_age))
    special = F.lower("page_url").contains(branch_token) | F.lower("source_name").contains(branch_token)
    keyed = keyed.where(~special | rules.concerns_branch(text.casefold(joined)))
    gated = keyed.withColumn("_gate", rules.gate_category(F.col("_folded"), groups)).where("_gate is not null")
    if stored is not None:
        keys = state.stored_keys(stored, keep_params)
        for key in ("url_key", "text_key"):
            gated = dedupe.drop_held(gated, keys, key)
    return gated


def settle(classified: DataFrame, now: Column) -> DataFrame:
    """Final category, event key and the tests that need the classifier's answer."""
    # names and dates are cut to the stored width first, so that an event's key is that of its stored row
    cut = {"event_name": text.cap(F.col("event_name"), vocab.EVENT_NAME_CHARS),
           "event_date": text.cap(F.col("event_date"), vocab.EVENT_DATE_CHARS)}
    final = classified.withColumns(cut).withColumn("category", rules.final_category(
        F.col("answer_category"), F.col("answer_failed"), F.col("_gate"), F.col("source_name"), F.col("source_type")))
    fallback = F.col("answer_category").isNull() & F.col("answer_failed")
    # a fallback name says nothing about the event, so it makes no event key
    final = final.where("category is not null").withColumn("event_key", F.when(
        ~fallback, state.event_key(F.col("source_name"), F.col("event_name"), F.col("event_date"))))
    named = final.withColumns({
        "event_name": F.when(fallback, F.concat(F.lit("[Fallback] Event detected via keywords ("), "category", F.lit(")"))).otherwise(F.col("event_name")),
        "event_date": F.when(fallback, F.lit("Not specified")).otherwise(F.col("event_date")),
    })
    past = (F.col("category") != "academic_calendar") & times.is_past_event(F.col("event_date"), now)
    return named.where(~past & urls.is_safe_post_url(F.col("source_url")))


def number_events(events: DataFrame, stored: DataFrame | None, order: str = "item_seq") -> DataFrame:
    """Next ids of each category family, after the highest number stored."""
    base = F.concat(F.lit("external_"), rules.category_code(F.col("category")))
    numbered = ids.number_within(events.withColumn("base", base), ["base"], [order], "_n")
    if stored is not None:
        numbered = unique_left_join(numbered, ids.next_numbers(stored, "id"), ["base"])
    else:
        numbered = numbered.withColumn("last_number", F.lit(0).cast("bigint"))
    at = F.col("_n") + F.coalesce("last_number", F.lit(0))
    return numbered.withColumn("id", ids.padded_id(F.col("base"), at, "_")).drop("base", "_n", "last_number")


def shape_events(events: DataFrame, now: Column) -> DataFrame:
    shaped = events.withColumns({
        "post_text": text.cap(F.col("text"), vocab.POST_TEXT_CHARS),
        "image_text": F.nullif(text.cap(F.col("image_text"), vocab.IMAGE_TEXT_CHARS), F.lit("")),
        "is_cancellation": F.coalesce("is_cancellation", F.lit(False)),
        "scraped_at": now, "post_date": times.post_date(now, F.col("posted_at")),
    })
    return shaped.select(*EVENT_COLUMNS, "batch")


@dataclass
class StoredRun:
    """Events saved by a sweep, their digest as rows and as counts, and the rows per stage."""

    events: DataFrame
    digest: DataFrame
    counts: DataFrame
    summary: DataFrame


def run_posts(items: DataFrame, pages: DataFrame, stored: DataFrame | None, now: Column,
              mode: str = vocab.DEFAULT_MODE, batch: str = "all", classify: Classifier = rule_classifier,
              extract: Extractor | None = None, unmatched: str = "quarantine", keep_params=None,
              groups=rules.DEFAULT_GROUPS) -> PostRun:
    """One sweep.  Only rows that pass every test may claim a dedupe key, so dedupe comes last."""
    posts = cut_lineage(page_posts(items, pages, mode, now, extract, batch, unmatched))
    gated = gate_posts(posts, now, mode, stored, keep_params, groups=groups)
    # the answers are written down: a replay must not ask an outside classifier again
    settled = settle(cut_lineage(classify(gated)), now)
    fresh = settled if stored is None else dedupe.drop_held(settled, state.stored_keys(stored, keep_params), "event_key")
    # only keys are sorted and numbered; texts meet the ids of the events at the end
    keys = fresh.select("page_seq", "item_seq", "category", "url_key", "text_key", "event_key")
    ranked = ids.number_rows(keys, ["page_seq", "item_seq"], "_ord")
    kept = dedupe.greedy_dedupe(ranked, "_ord", ["url_key", "text_key", "event_key"])
    numbered = number_events(kept, stored, "_ord").select("page_seq", "item_seq", "id")
    events = cut_lineage(shape_events(settled.join(numbered, ["page_seq", "item_seq"]), now))
    stages = {"posts": posts, "candidates": ranked, "saved": events}
    counted = [df.select(F.lit(name).alias("stage")).groupBy("stage").agg(F.count("*").alias("rows")) for name, df in stages.items()]
    return PostRun(events, functools.reduce(DataFrame.unionByName, counted))


def store_posts(items: DataFrame, pages: DataFrame, events_path: str, now: Column, **options) -> StoredRun:
    """One sweep that is kept: events found are upserted by id, the digest tells what is new.

    What is stored already is known by its three keys, so a sweep that is repeated adds nothing.
    """
    spark = items.sparkSession
    run = run_posts(items, pages, tables.read_table(spark, events_path), now, **options)
    tables.load_upsert(run.events.drop("batch"), events_path, ["id"])
    return StoredRun(run.events, tagging.digest_rows(run.events, {"url": "source_url"}), tagging.digest_counts(run.events), run.summary)


def active_events(spark: SparkSession, events_path: str) -> DataFrame:
    """Stored events with ``is_active``: false once the same source has cancelled that code later."""
    return tagging.cancel_earlier(tables.read_table(spark, events_path))
