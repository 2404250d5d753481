"""Queries on conflict policies: what is stored already and what a new load does to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from railtide.functions import rules, text
from railtide.operators import dedupe, ids, merge
from railtide.registry.base import pick, query

STORED_SQL = "stored AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'old' AS stamp FROM customer WHERE c_nationkey % 3 <> 0)"
NEW_SQL = "fresh AS (SELECT c_custkey AS id, c_name || '!' AS name, c_acctbal * 2 AS balance, 'new' AS stamp FROM customer WHERE c_nationkey % 3 <> 1)"


def snapshots(table):
    rows = table("customer")
    stored = rows.where("c_nationkey % 3 <> 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("old").alias("stamp"))
    fresh = rows.where("c_nationkey % 3 <> 1").select(
        F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("!")).alias("name"), (F.col("c_acctbal") * 2).alias("balance"), F.lit("new").alias("stamp"))
    return stored, fresh


@query("insert_if_absent", f"""
WITH {STORED_SQL}, {NEW_SQL} SELECT * FROM stored UNION ALL SELECT * FROM fresh WHERE id NOT IN (SELECT id FROM stored)
""")
def insert_if_absent(table, spark):
    stored, fresh = snapshots(table)
    return stored.unionByName(merge.insert_if_absent(stored, fresh, ["id"]))


@query("upsert_touch", f"""
WITH {STORED_SQL}, {NEW_SQL}
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NOT NULL THEN o.name ELSE n.name END AS name,
  CASE WHEN o.id IS NOT NULL THEN o.balance ELSE n.balance END AS balance, CASE WHEN n.id IS NOT NULL THEN 'now' ELSE o.stamp END AS stamp
FROM stored o FULL JOIN fresh n ON o.id = n.id
""")
def upsert_touch(table, spark):
    stored, fresh = snapshots(table)
    return merge.insert_or_touch(stored, fresh, ["id"], "stamp", F.lit("now"))


@query("upsert_full", f"""
WITH {STORED_SQL}, {NEW_SQL} SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE id NOT IN (SELECT id FROM fresh)
""")
def upsert_full(table, spark):
    return merge.upsert(*snapshots(table), ["id"])


@query("update_only", f"""
WITH {STORED_SQL}, {NEW_SQL}
SELECT o.id, coalesce(n.name, o.name) AS name, coalesce(n.balance, o.balance) AS balance, coalesce(n.stamp, o.stamp) AS stamp, n.id IS NOT NULL AS was_updated
FROM stored o LEFT JOIN fresh n ON o.id = n.id
""")
def update_only(table, spark):
    return merge.update_only(*snapshots(table), ["id"])


@query("update_report", f"""
WITH {STORED_SQL}, {NEW_SQL}
SELECT count(*) FILTER (WHERE id IN (SELECT id FROM stored)) AS matched, count(*) FILTER (WHERE id NOT IN (SELECT id FROM stored)) AS unmatched FROM fresh
""")
def update_report(table, spark):
    return merge.update_report(*snapshots(table), ["id"])


@query("renumber_repair", """
WITH e AS (
  SELECT d.doc_id, CASE d.doc_id % 7 WHEN 0 THEN 'external_acad_' || (d.doc_id % 50) WHEN 1 THEN 'external-lgu-' || (d.doc_id % 40) ELSE 'x_' || d.doc_id END AS id,
    CASE d.doc_id % 5 WHEN 0 THEN 'PAGASA desk' WHEN 1 THEN 'City of ' || d.source WHEN 2 THEN 'Public Information ' || d.source ELSE 'School ' || d.source END AS source_name,
    CASE d.doc_id % 6 WHEN 0 THEN 'Number Coding lifted' WHEN 1 THEN 'Classes resume' ELSE 'Event ' || d.doc_id END AS event_name,
    CASE d.doc_id % 4 WHEN 0 THEN 'CLASS_SUSPENSION' WHEN 1 THEN 'EXAM_WEEK' ELSE 'WEATHER_ADVISORY' END AS event_code,
    coalesce(l.quality = 1, false) AS is_cancellation, d.n_chars AS scraped_at, nullif(substr(trim(d.text), 1, 100), '') AS key
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY scraped_at, doc_id) AS rn FROM e) WHERE rn = 1 OR key IS NULL),
c AS (SELECT *, regexp_matches(lower(event_name), 'number coding|coding scheme|caravan') AS traffic,
  CASE WHEN regexp_matches(lower(event_name), 'number coding|coding scheme|caravan') THEN 'lgu' WHEN contains(lower(source_name), 'pagasa') THEN 'pagasa'
    WHEN regexp_matches(lower(source_name), 'government|pio|public information|municipality|city of|lgu') THEN 'lgu' ELSE 'acad' END AS category,
  coalesce(TRY_CAST(regexp_extract(id, '^[^_]*_[^_]*_(\\d+)$', 1) AS BIGINT), TRY_CAST(regexp_extract(id, '^[^-]*-[^-]*-(\\d+)$', 1) AS BIGINT), 999999) AS old FROM k),
f AS (SELECT *, traffic OR (event_code IN ('CLASS_SUSPENSION', 'EXAM_WEEK') AND NOT regexp_matches(lower(event_name), 'resumed|resume|lifted|called off|cancelled')) AS clear FROM c)
SELECT doc_id, 'external_' || category || '_' || printf('%04d', row_number() OVER (PARTITION BY category ORDER BY old, scraped_at, doc_id)) AS id, category,
  CASE WHEN traffic THEN 'CIVIC_MAINTENANCE' ELSE event_code END AS event_code, is_cancellation AND NOT clear AS is_cancellation,
  CASE WHEN NOT clear AND is_cancellation THEN event_code END AS cancellation_target_code FROM f
""")
def renumber_repair(table, spark):
    from railtide.plans.repair import repair_events

    doc = F.col("doc_id")

    rows = table("documents").join(table("labels").select("doc_id", "quality"), "doc_id", "left")
    other = F.concat(F.lit("x_"), doc)
    events = rows.select(
        "doc_id",
        pick(doc % 7, F.concat(F.lit("external_acad_"), doc % 50), F.concat(F.lit("external-lgu-"), doc % 40), *[other] * 5).alias("id"),
        pick(doc % 5, F.lit("PAGASA desk"), F.concat(F.lit("City of "), "source"), F.concat(F.lit("Public Information "), "source"), *[F.concat(F.lit("School "), "source")] * 2).alias("source_name"),
        pick(doc % 6, F.lit("Number Coding lifted"), F.lit("Classes resume"), *[F.concat(F.lit("Event "), doc)] * 4).alias("event_name"),
        pick(doc % 4, F.lit("CLASS_SUSPENSION"), F.lit("EXAM_WEEK"), *[F.lit("WEATHER_ADVISORY")] * 2).alias("event_code"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("is_cancellation"), F.col("n_chars").alias("scraped_at"),
        F.col("text").alias("post_text"), F.lit(None).cast("string").alias("image_text"),
    ).withColumn("cancellation_target_code", F.when(F.col("is_cancellation"), F.col("event_code")))
    out = repair_events(events, tie="doc_id")
    return out.select("doc_id", "id", "category", "event_code", "is_cancellation", "cancellation_target_code")


@query("year_status", """
SELECT year(o_orderdate) AS year, count(*) AS rows, count(*) FILTER (WHERE o_totalprice > 499900) AS bad_rows, count(*) FILTER (WHERE o_totalprice > 499900) = 0 AS accepted
FROM orders GROUP BY 1
""")
def year_status(table, spark):
    from railtide.operators import checks

    checked = checks.with_rejects(table("orders").withColumn("year", F.year("o_orderdate").cast("bigint")), {"price": F.col("o_totalprice") <= 499900})
    return checks.group_status(checked, ["year"])


@query("ledger_append", """
SELECT DISTINCT url FROM pages WHERE page_id % 3 = 0
UNION SELECT DISTINCT url FROM pages WHERE page_id % 5 = 0
""")
def ledger_append(table, spark):
    pages = table("pages")
    ledger = pages.where("page_id % 3 = 0").select("url").distinct()
    seen = pages.where("page_id % 5 = 0").select("url")
    return ledger.unionByName(merge.insert_if_absent(ledger, seen.distinct(), ["url"]))


@query("raw_prefix_dedupe", """
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY substr(trim(text), 1, 100) ORDER BY n_chars, doc_id) AS rn FROM documents) WHERE rn = 1
""")
def raw_prefix_dedupe(table, spark):
    keyed = table("documents").select("doc_id", "n_chars", text.raw_text_key(F.col("text")).alias("key"))
    return dedupe.keep_first_or_blank(keyed, "key", ["n_chars", "doc_id"]).select("doc_id")


@query("id_families", """
WITH k AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'external_acad_' || c_custkey WHEN 1 THEN 'external_acad_cal_' || c_custkey ELSE 'external_lgu_' || c_custkey END AS id FROM customer)
SELECT regexp_extract(id, '^(.*)_(\\d+)$', 1) AS base, max(CAST(regexp_extract(id, '_(\\d+)$', 1) AS BIGINT)) AS last_number FROM k GROUP BY 1
""")
def id_families(table, spark):
    key = F.col("c_custkey")
    made = F.concat(F.get(F.array(*[F.lit(f"external_{c}_") for c in ("acad", "acad_cal", "lgu")]), (key % 3).cast("int")), key)
    return ids.next_numbers(table("customer").select(made.alias("id")), "id")


@query("id_numbers", """
WITH k AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'external_acad_' || c_custkey WHEN 1 THEN 'a-b-' || c_custkey WHEN 2 THEN 'ab_' || c_custkey ELSE 'x_y_' END AS id FROM customer)
SELECT c_custkey, coalesce(TRY_CAST(regexp_extract(id, '^.*_.*_(\\d+)$', 1) AS BIGINT), TRY_CAST(regexp_extract(id, '^.*-.*-(\\d+)$', 1) AS BIGINT), 999999) AS n FROM k
""")
def id_numbers(table, spark):
    key = F.col("c_custkey")
    made = F.get(F.array(F.concat(F.lit("external_acad_"), key), F.concat(F.lit("a-b-"), key), F.concat(F.lit("ab_"), key), F.lit("x_y_")), (key % 4).cast("int"))
    return table("customer").select("c_custkey", rules.id_number(made).alias("n"))
