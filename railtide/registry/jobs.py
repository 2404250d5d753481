"""Queries on what jobs read, keep and hand on: feeds, stored keys, hooks, books, ledgers and exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from railtide import vocab
from railtide.operators import dedupe, ids, nested
from railtide.plans import calendars, posts
from railtide.registry.base import NOW, pick, query
from railtide.registry.texts import TEXT_KEY
from railtide.sinks import tables
from railtide.sources import feeds, files, state

def _folder(spark, name: str) -> str:
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("stored_keys", f"""
WITH d AS (SELECT doc_id, 'https://www.facebook.com/' || lower(source) || '/posts/' || doc_id % 700 AS u, {TEXT_KEY} AS t,
  lower(source) || '|' || doc_id % 900 AS e FROM documents),
s AS (SELECT * FROM d WHERE doc_id % 5 = 0)
SELECT doc_id FROM d WHERE u NOT IN (SELECT u FROM s) AND (t IS NULL OR t NOT IN (SELECT t FROM s WHERE t IS NOT NULL)) AND e NOT IN (SELECT e FROM s)
""")
def stored_keys(table, spark):
    """New posts against a written table of events: URL, text and event keys, each an anti-join of two columns."""
    doc = F.col("doc_id")
    items = table("documents").select(
        doc, F.concat(F.lit("https://www.facebook.com/"), "source", F.lit("/posts/"), (doc % 700).cast("string"), F.lit("?ref=x")).alias("source_url"),
        F.col("text").alias("post_text"), F.lit(None).cast("string").alias("image_text"), F.col("source").alias("source_name"),
        F.concat(F.lit(" Event "), (doc % 900).cast("string")).alias("event_name"), F.lit("2024-01-31").alias("event_date"))
    path = f"{_folder(spark, 'stored-keys')}/events"
    items.where(doc % 5 == 0).drop("doc_id").write.parquet(path)
    held = state.stored_keys(spark.read.parquet(path))
    keyed = items.select("doc_id", *state.key_columns())
    for key in ("url_key", "text_key", "event_key"):
        keyed = dedupe.drop_held(keyed, held, key)
    return keyed.select("doc_id")


@query("image_texts", f"""
WITH m AS (SELECT doc_id, source, k, CASE WHEN k = 2 AND doc_id % 3 = 0 THEN NULL ELSE 'http://img/' || doc_id % 40 || '-' || k END AS uri,
    CASE WHEN doc_id % 2 = 0 THEN 'Given words ' || k END AS supplied
  FROM documents, (VALUES (0), (1), (2)) v(k) WHERE k < doc_id % 4),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, k) AS place FROM m WHERE uri IS NOT NULL),
t AS (SELECT doc_id, k, coalesce(CASE WHEN place <= {vocab.EXTRACTIONS_PER_PAGE} AND k <> 1 THEN 'read ' || uri END, supplied) AS t FROM r)
SELECT d.doc_id, coalesce(string_agg(t, ' ' ORDER BY k), '') AS image_text FROM documents d LEFT JOIN t USING (doc_id) GROUP BY 1
""")
def image_texts(table, spark):
    """Images of posts read within a budget per source, each address once; what came with an image stands in."""
    doc = F.col("doc_id")
    entries = [
        F.struct(
            F.struct(F.when(~(F.lit(k == 2) & (doc % 3 == 0)), F.concat(F.lit("http://img/"), doc % 40, F.lit(f"-{k}"))).alias("uri")).alias("photo_image"),
            F.lit(None).cast("string").alias("thumbnail"), F.lit(None).cast("string").alias("url"),
            F.when(doc % 2 == 0, F.lit(f"Given words {k}")).alias("ocrText"))
        for k in range(3)
    ]
    shown = table("documents").select(doc, doc.alias("item_seq"), "source", F.slice(F.array(*entries), 1, (doc % 4).cast("int")).alias("media"))

    def extract(uris):
        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = "read " + batch["uri"]
                yield pd.DataFrame({"uri": batch["uri"], "extracted": found.where(~batch["uri"].str.endswith("-1"), None)})

        return uris.mapInPandas(read, "uri string, extracted string")

    return posts.read_images(shown, "source", ["source", "item_seq"], extract).select("doc_id", "image_text")


@query("classify_once", """
SELECT doc_id, CASE WHEN n % 7 = 0 THEN NULL WHEN n % 3 = 0 THEN 'academic' WHEN n % 3 = 1 THEN 'lgu' END AS answer_category,
  CASE WHEN n % 7 <> 0 AND n % 2 = 0 THEN 'Event ' || n END AS event_name,
  CASE WHEN n % 7 = 0 THEN NULL ELSE n % 5 = 0 END AS is_cancellation, n % 7 = 0 AS answer_failed
FROM (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents)
""")
def classify_once(table, spark):
    """Texts classified once per distinct input by a hook that returns JSON text, or nothing where it fails."""
    def ask(inputs):
        def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                sizes = batch["text"].str.len()
                kinds = sizes.mod(3).map({0: "academic", 1: "lgu", 2: "weather"})
                names = [f"Event {n}" if n % 2 == 0 else "N/A" for n in sizes]
                given = [
                    f'{{"category": "{c}", "event_name": "{e}", "is_cancellation": {str(n % 5 == 0).lower()}}}' if n % 7 else None
                    for c, e, n in zip(kinds, names, sizes)
                ]
                yield pd.DataFrame({"key": batch["key"], "answer": given})

        return inputs.mapInPandas(answer, "key string, answer string")

    shown = table("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.lit("").alias("image_text"))
    answered = posts.classify_once(shown, ask)
    flag = F.when(~F.col("answer_failed"), F.col("is_cancellation"))
    return answered.select("doc_id", "answer_category", "event_name", flag.alias("is_cancellation"), "answer_failed")


@query("post_items", f"""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'https://www.facebook.com/' || source ELSE 'https://fb/' || source END AS asked_url,
  'https://www.facebook.com/' || source || '/posts/' || doc_id AS source_url,
  CASE doc_id % 4 WHEN 0 THEN 1704067200 + doc_id WHEN 1 THEN 1706659200 + doc_id END AS posted_second,
  md5(CASE doc_id % 5 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN 're ' || doc_id WHEN 2 THEN 'shared' WHEN 3 THEN 'attached' ELSE '' END) AS caption_md5,
  length(left(CASE doc_id % 5 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN 're ' || doc_id WHEN 2 THEN 'shared' WHEN 3 THEN 'attached' ELSE '' END, {vocab.POST_TEXT_CHARS})) AS capped
FROM documents
""")
def post_items(table, spark):
    """Scraped items written as JSON lines and read by one schema: the first text, link and time that is there."""
    doc, none = F.col("doc_id"), F.lit(None).cast("string")
    page = F.concat(F.lit("https://www.facebook.com/"), "source")
    link = F.concat(page, F.lit("/posts/"), doc, F.lit("&ref=x"))
    which = doc % 5
    shown = table("documents").select(
        F.when(doc % 3 != 0, F.concat(F.lit("https://fb/"), "source")).otherwise("").alias("inputUrl"), page.alias("facebookUrl"),
        F.when(doc % 2 == 0, link).otherwise(F.lit("")).alias("url"), link.alias("topLevelUrl"), F.col("source").alias("pageName"),
        F.when(doc % 4 == 0, F.date_format(F.timestamp_seconds(F.lit(1704067200) + doc), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(doc % 4 == 2, "soon").alias("time"),
        F.when(doc % 2 == 1, F.when(doc % 4 == 1, F.lit(1706659200) + doc).otherwise(0)).cast("double").alias("timestamp"),
        F.when(which == 0, F.col("text")).otherwise("").alias("text"), F.when(which == 1, F.concat(F.lit("re "), doc)).alias("resharedText"),
        F.struct(F.when(which == 2, F.lit("shared")).alias("text")).alias("sharePost"),
        F.when(which == 3, F.struct(F.lit("attached").alias("text"))).alias("attachedPost"), F.array().cast(nested.MEDIA_TYPE).alias("media"))
    path = f"{_folder(spark, 'post-items')}/items"
    shown.write.json(path)
    read = feeds.post_items(feeds.read_items(spark, path))
    return read.select(
        F.regexp_extract("source_url", r"(\d+)$", 1).cast("bigint").alias("doc_id"), "asked_url", "source_url",
        F.unix_seconds("posted_at").alias("posted_second"), F.md5("raw_text").alias("caption_md5"),
        F.length(F.substring("raw_text", 1, vocab.POST_TEXT_CHARS)).cast("bigint").alias("capped"))


@query("tagged_books", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'academic' ELSE 'operational' END AS friction_domain,
  CASE o_orderkey % 3 WHEN 0 THEN 'a "quoted", cell' WHEN 1 THEN 'two' || chr(10) || 'lines' ELSE o_orderpriority END AS note,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS extra
FROM orders
""")
def tagged_books(table, spark):
    """Books with headers written per domain and read back as one table; a missing book is skipped, empty rows go."""
    key = F.col("o_orderkey")
    note = pick(key % 3, F.lit('a "quoted", cell'), F.lit("two\nlines"), F.col("o_orderpriority"))
    folder = _folder(spark, "books")
    none = F.lit(None).cast("string")
    rows = table("orders").select(key.cast("string").alias("o_orderkey"), note.alias("note"), F.col("o_orderstatus").alias("extra"))
    empty = rows.where(F.col("extra") == "F").select(none.alias("o_orderkey"), none.alias("note"), none.alias("extra"))
    for rest, name in ((0, "a"), (1, "b")):
        book = rows.where(F.col("o_orderkey").cast("bigint") % 2 == rest).unionByName(empty)
        (book.drop("extra") if rest == 0 else book).write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    read = files.read_tagged(
        spark, {"academic": f"{folder}/a", "operational": f"{folder}/b", "pagasa": None}, "friction_domain", ["o_orderkey", "note"])
    return read.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "friction_domain", "note", "extra")


@query("file_periods", """
WITH n AS (SELECT event_id, ['january', 'Feb', 'MAR', 'april', 'jun', 'Sept', 'december'][CAST(event_id % 7 AS INTEGER) + 1] AS month,
    [1, 2, 3, 4, 6, 9, 12][CAST(event_id % 7 AS INTEGER) + 1] AS number, 2020 + event_id % 9 AS year FROM events)
SELECT event_id, CAST(year AS INTEGER) AS year, CAST(number AS INTEGER) AS month,
  row_number() OVER (ORDER BY year, number, event_id) AS place
FROM n WHERE event_id % 10 NOT IN (0, 1, 2)
""")
def file_periods(table, spark):
    """File names: sheets of a month, without temporary files, other kinds and other topics; in order of month."""
    from railtide.operators import ids

    event = F.col("event_id")
    months = pick(event % 7, *map(F.lit, ("january", "Feb", "MAR", "april", "jun", "Sept", "december")))
    topic = F.when(event % 10 == 1, "other").otherwise("AfCS")
    stem = F.concat(F.when(event % 10 == 0, "~$").otherwise(""), topic, F.lit(" "), months, F.lit("_"), 2020 + event % 9)
    suffix = F.when(event % 10 == 2, ".pdf").when(event % 2 == 0, ".CSV").otherwise(".xlsx")
    listed = table("events").select(event, F.concat(stem, suffix).alias("name"), stem.alias("stem"))
    found = files.with_file_period(listed)
    return ids.number_rows(found, ["year", "month", "event_id"], "place").select(
        "event_id", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "place")


@query("ledger_export", f"""
WITH d AS (SELECT doc_id, source, 'https://x/' || doc_id % 300 AS url FROM documents WHERE source IS NOT NULL),
first AS (SELECT DISTINCT url FROM d WHERE doc_id % 2 = 0),
late AS (SELECT * FROM d WHERE doc_id % 2 = 1 AND url NOT IN (SELECT url FROM first))
SELECT 'stored' AS kind, source AS name, count(*) AS n FROM (SELECT * FROM d WHERE doc_id % 2 = 0 UNION ALL SELECT * FROM late) GROUP BY 2
UNION ALL SELECT 'ledger', '', (SELECT count(*) FROM first) + (SELECT count(DISTINCT url) FROM late)
UNION ALL SELECT 'excluded', '', count(*) FROM (SELECT DISTINCT source FROM d) WHERE contains(lower(source), '1')
""")
def ledger_export(table, spark):
    """Two runs that export rows per school and write down their URLs; the second leaves out what the ledger holds."""
    doc, folder = F.col("doc_id"), _folder(spark, "ledger")
    rows = table("documents").where("source is not null").select(
        doc, F.col("source").alias("source_name"), F.concat(F.lit("https://x/"), doc % 300).alias("source_url"), F.lit("academic_calendar").alias("category"))
    for rest in (0, 1):
        ledger = state.read_ledger(spark, f"{folder}/ledger").select(F.col("url").alias("source_url"))
        fresh = dedupe.drop_held(rows.where(doc % 2 == rest), ledger, "source_url").withColumn("id", doc.cast("string"))
        fresh.write.parquet(f"{folder}/run{rest}")
        saved = spark.read.parquet(f"{folder}/run{rest}")
        tables.export_calendars(saved, f"{folder}/out")
        tables.append_ledger(saved.select(F.col("source_url").alias("url")), f"{folder}/ledger")
    exported = spark.read.csv(f"{folder}/out", header=True)
    assert set(vocab.CALENDAR_COLUMNS) <= set(exported.columns)
    names = rows.select(F.col("source_name").alias("name")).distinct()
    kept = calendars.school_pages(names, ("1",))
    return (
        exported.groupBy(F.lit("stored").alias("kind"), F.col("source_name").alias("name")).agg(F.count("*").alias("n"))
        .unionByName(state.read_ledger(spark, f"{folder}/ledger").agg(F.count("*").alias("n")).select(F.lit("ledger").alias("kind"), F.lit("").alias("name"), "n"))
        .unionByName(names.join(kept, "name", "left_anti").agg(F.count("*").alias("n")).select(F.lit("excluded").alias("kind"), F.lit("").alias("name"), "n"))
    )


@query("calendar_store", """
WITH p AS (SELECT source, row_number() OVER (ORDER BY source) AS page FROM documents WHERE source IS NOT NULL GROUP BY 1),
d AS (SELECT doc_id, page, 'https://www.facebook.com/' || source || '.page/posts/' || doc_id % 300 AS url, doc_id % 8 AS run
  FROM documents JOIN p USING (source) WHERE doc_id % 4 = 0),
one AS (SELECT url, min(page) AS page, min(doc_id) AS first, 1 AS run FROM d WHERE run = 0 GROUP BY 1),
two AS (SELECT url, min(page) AS page, min(doc_id) AS first, 2 AS run FROM d WHERE run = 4 AND url NOT IN (SELECT url FROM one) GROUP BY 1)
SELECT 'external_acad_cal_' || printf('%04d', row_number() OVER (ORDER BY run, page, first)) AS id, url AS source_url, 1 AS exported, true AS in_ledger
FROM (SELECT * FROM one UNION ALL SELECT * FROM two)
""")
def calendar_store(table, spark):
    """Stored releases after three runs of the job, with how often each was exported: the last repeats the second."""
    doc, folder = F.col("doc_id"), _folder(spark, "calendars")
    named = table("documents").where("source is not null")
    page = F.concat(F.lit("https://www.facebook.com/"), "source", F.lit(".page"))
    release = F.when(doc % 4 == 0, F.lit("Our official Academic Calendar for A.Y. 2026-2027 is released")).otherwise(F.lit("Good morning"))
    items = named.select(
        doc, doc.alias("item_seq"), page.alias("asked_url"), F.col("source").alias("page_name"),
        F.concat(page, F.lit("/posts/"), doc % 300).alias("source_url"), F.lit("2024-01-31 00:00:00").cast("timestamp").alias("posted_at"),
        release.alias("raw_text"), F.array().cast(nested.MEDIA_TYPE).alias("media"))
    names = named.select("source").distinct()
    pages = ids.number_rows(names, ["source"], "page_seq").select("page_seq", F.col("source").alias("name"), page.alias("url"), F.lit("Station").alias("station"))
    events, ledger, out = (f"{folder}/{n}" for n in ("events", "ledger", "out"))
    for rest in (0, 4, 4):
        calendars.store_calendars(items.where(doc % 8 == rest).drop("doc_id"), pages, events, ledger, out, F.lit(NOW).cast("timestamp"))
    exported = spark.read.csv(out, header=True).groupBy("id").agg(F.count("*").cast("int").alias("exported"))
    seen = state.read_ledger(spark, ledger).select(F.col("url").alias("source_url"), F.lit(True).alias("in_ledger"))
    return (
        tables.read_table(spark, events).select("id", "source_url").join(exported, "id", "left").join(seen, "source_url", "left")
        .select("id", "source_url", "exported", F.coalesce("in_ledger", F.lit(False)).alias("in_ledger"))
    )
