"""Queries on time-stamped readings: levels, gaps, slots, freshness, sweeps."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules, times
from railtide.operators import gapfill, nested, topk
from railtide.registry.base import NOW, pick, query
from railtide.sources import feeds

NOW_SQL = f"TIMESTAMP '{NOW}'"


def now():
    return F.lit(NOW).cast("timestamp")


@query("rainfall_level", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN value / 10 > 30 THEN 'Red' WHEN value / 10 >= 15 THEN 'Orange'
  WHEN value / 10 >= 7.5 THEN 'Yellow' ELSE 'None' END AS level FROM events
""")
def rainfall_level(table, spark):
    rain = F.when(F.col("event_type") != "error", F.col("value") / 10)
    return table("events").select("event_id", rules.rainfall_level(rain).alias("level"))


READING = {"temperature": 28.5, "humidity": 75.0}


@query("locf_fallback", """
WITH e AS (SELECT event_id, user_id, event_type NOT IN ('error', 'view') AS ok, event_type = 'view' AND event_id % 2 = 0 AS has_prev,
    value AS t, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 2 END AS h, user_id % 20 AS run FROM events),
n AS (SELECT *, last_value(CASE WHEN ok THEN event_id END IGNORE NULLS) OVER (PARTITION BY run ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS src FROM e)
SELECT n.event_id, CASE WHEN n.ok THEN 'fresh' WHEN s.event_id IS NOT NULL THEN 'neighbour' WHEN n.has_prev THEN 'stored' ELSE 'constant' END AS fallback_level,
  CASE WHEN n.ok THEN coalesce(n.t, 28.5) WHEN s.event_id IS NOT NULL THEN coalesce(s.t, 28.5) WHEN n.has_prev THEN n.user_id * 1.0 ELSE 28.5 END AS temperature,
  CASE WHEN n.ok THEN coalesce(n.h, 75.0) WHEN s.event_id IS NOT NULL THEN coalesce(s.h, 75.0) ELSE 75.0 END AS humidity
FROM n LEFT JOIN e s ON s.event_id = n.src
""")
def locf_fallback(table, spark):
    work = table("events").select(
        "event_id", (F.col("user_id") % 20).alias("run"), (~F.col("event_type").isin("error", "view")).alias("ok"),
        ((F.col("event_type") == "view") & (F.col("event_id") % 2 == 0)).alias("has_prev"),
        F.col("value").alias("temperature"), F.when(F.col("event_id") % 11 != 0, F.col("value") / 2).alias("humidity"),
        F.col("user_id").cast("double").alias("temperature_prev"), F.lit(None).cast("double").alias("humidity_prev"),
    )
    # sparse order values and short chunks: every run carries over many of them
    work = work.withColumn("place", F.col("event_id") * 10_000_000)
    near = gapfill.fill_from_neighbours(work, ["run"], "place", list(READING), F.col("ok"), chunk_rows=16)
    filled = gapfill.fallback_chain(
        near, list(READING),
        [("fresh", F.col("ok"), ""), ("neighbour", F.col("has_near"), "_near"), ("stored", F.col("has_prev"), "_prev")], READING)
    return gapfill.take_filled(filled, ["event_id"], list(READING))


def _first_days(daily, *values):
    """Per user its first days, sorted: today and as many as a forecast has, dropped by rank before the shuffle as well."""
    by_day = Window.partitionBy("user_id").orderBy("day")
    first = daily.withColumn("rank", F.row_number().over(by_day)).where(F.col("rank") <= vocab.FORECAST_DAYS + 1)
    return first.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("day", *values))).alias("d"))


@query("forecast_slots", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS hi, min(value) AS lo FROM events GROUP BY ALL),
a AS (SELECT user_id, list(strftime(day, '%Y-%m-%d') ORDER BY day) AS days, list(hi ORDER BY day) AS his, list(lo ORDER BY day) AS los FROM d GROUP BY 1)
SELECT 'FCT-U' || user_id || '-' || printf('%04d', i) AS id, user_id, CAST(i AS INTEGER) AS slot, days[i + 1] AS forecast_date,
  his[i + 1] AS temp_max, los[i + 1] AS temp_min
FROM (SELECT *, unnest(range(1, least(7, len(days) - 1) + 1)) AS i FROM a)
""")
def forecast_slots(table, spark):
    daily = table("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("value").alias("hi"), F.min("value").alias("lo"))
    packed = _first_days(daily, "hi", "lo")
    arrays = packed.select(
        "user_id", F.transform("d", lambda x: F.date_format(x["day"], "yyyy-MM-dd")).alias("days"),
        F.transform("d", lambda x: x["hi"]).alias("his"), F.transform("d", lambda x: x["lo"]).alias("los"))
    out = nested.forecast_slots(arrays, {"days": "forecast_date", "his": "temp_max", "los": "temp_min"}, "days")
    return out.select(
        nested.slot_id(F.concat(F.lit("U"), "user_id"), F.col("slot")).alias("id"), "user_id", "slot", "forecast_date", "temp_max", "temp_min")


@query("staleness", f"""
WITH s AS (SELECT user_id, max(ts) AS seen FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT c_custkey, CAST(round(epoch_us({NOW_SQL}) - epoch_us(seen)) AS BIGINT) AS age_micros,
  coalesce((epoch_us({NOW_SQL}) - epoch_us(seen)) / 6e7 > 4320, true) AS is_stale
FROM customer LEFT JOIN s ON c_custkey = user_id
""")
def staleness(table, spark):
    reports = table("events").where("event_type = 'purchase'").select(
        F.col("user_id").alias("c_custkey"), F.col("ts").alias("fetched_at"), F.col("ts").alias("observed_at"))
    seen = gapfill.last_seen(reports, "c_custkey")
    out = gapfill.audit_freshness(table("customer").select("c_custkey"), seen, "c_custkey", now(), 4320.0)
    return out.select("c_custkey", (times.micros(now()) - times.micros(F.col("last_seen"))).alias("age_micros"), "is_stale")


@query("last_seen_text", """
WITH e AS (SELECT user_id, event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+08:00' ELSE 'soon' END AS f, strftime(ts, '%Y-%m-%d %H:%M:%S') AS o, ts FROM events),
t AS (SELECT user_id, event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('second', ts) - INTERVAL 8 HOUR END AS seen FROM e)
SELECT user_id, strftime(arg_max(seen, event_id) FILTER (WHERE seen IS NOT NULL), '%Y-%m-%d %H:%M:%S') AS last_seen FROM t GROUP BY 1
""")
def last_seen_text(table, spark):
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    shape = pick(F.col("event_id") % 4, F.lit(""), F.concat(ts, F.lit("Z")), F.concat(ts, F.lit("+08:00")), F.lit("soon"))
    reports = table("events").select(
        "user_id", "event_id", shape.alias("fetched_at"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("observed_at"))
    seen = gapfill.last_seen(reports, "user_id", order="event_id")
    return seen.select("user_id", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


@query("latest_snapshot", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def latest_snapshot(table, spark):
    rows = table("events").select("user_id", "ts", "event_id", "event_type", "value")
    return gapfill.latest_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("age_filter_sweeps", f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE (epoch_us({NOW_SQL}) - epoch_us(ts)) / 86400000000.0 END AS age FROM events)
SELECT mode, count(*) AS kept, count(*) FILTER (WHERE age IS NULL) AS unknown_age FROM e,
  (VALUES ('strong', 9.0), ('medium', 4.5), ('light', 2.25)) AS m(mode, days)
WHERE age IS NULL OR age <= days GROUP BY 1
""")
def age_filter_sweeps(table, spark):
    known = F.when(F.col("event_id") % 13 != 0, F.col("ts").cast("timestamp"))
    ages = table("events").select(times.age_days(now(), known).alias("age"))
    looks = [("strong", 9.0), ("medium", 4.5), ("light", 2.25)]
    counted = ages.agg(*[
        agg.alias(f"{m}_{name}") for m, days in looks for name, agg in (
            ("kept", F.count_if(times.within_age(F.col("age"), days))),
            ("unknown", F.count_if(F.col("age").isNull())))
    ])
    rows = F.array(*[F.struct(F.lit(m).alias("mode"), F.col(f"{m}_kept").alias("kept"), F.col(f"{m}_unknown").alias("unknown_age")) for m, _ in looks])
    return counted.select(F.inline(rows))


@query("post_ages", f"""
SELECT event_id, round(CASE event_id % 4 WHEN 3 THEN NULL ELSE greatest(0, (epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(date_trunc('second', ts))) / 86400000000.0) END, 6) AS age_days,
  strftime(CASE event_id % 4 WHEN 3 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE least(date_trunc('second', ts), TIMESTAMP '2024-01-20 00:00:00') END, '%Y-%m-%d %H:%M:%S') AS post_date
FROM events
""")
def post_ages(table, spark):
    at = F.lit("2024-01-20 00:00:00").cast("timestamp")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.col("event_id") % 4
    time_text = F.when(kind == 0, iso).when(kind == 3, F.lit("yesterday"))
    epoch = F.when(kind != 0, F.unix_seconds(F.col("ts").cast("timestamp")).cast("double"))
    work = table("events").select("event_id", times.post_time(time_text, epoch).alias("t"))
    return work.select(
        "event_id", F.round(times.age_days(at, F.col("t")), 6).alias("age_days"),
        F.date_format(times.post_date(at, F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("post_date"))


@query("past_event_skip", """
WITH o AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'on ' || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' to 2020-01-01'
  WHEN 2 THEN 'soon' ELSE '1998-02-31' END AS event_date, o_orderdate FROM orders)
SELECT o_orderkey, o_orderkey % 4 < 2 AND floor((epoch_us(TIMESTAMP '1998-06-15 12:00:00') - epoch_us(o_orderdate)) / 86400000000.0) > 14 AS is_past FROM o
""")
def past_event_skip(table, spark):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = pick(F.col("o_orderkey") % 4, F.concat(F.lit("on "), day), F.concat(day, F.lit(" to 2020-01-01")), F.lit("soon"), F.lit("1998-02-31"))
    return table("orders").select(
        "o_orderkey", times.is_past_event(text, F.lit("1998-06-15 12:00:00").cast("timestamp")).alias("is_past"))


@query("pretty_dates", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%B %d, %Y') WHEN 1 THEN strftime(o_orderdate, '%B %d, %Y') || ' to ' || strftime(o_orderdate + INTERVAL 3 DAY, '%B %d, %Y')
  WHEN 2 THEN 'Not specified' WHEN 3 THEN '2023-02-31' ELSE 'next week' END AS event_date,
  CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate + INTERVAL 14 HOUR + INTERVAL 5 MINUTE, '%B %d, %Y, %I:%M %p') WHEN 1 THEN strftime(o_orderdate + INTERVAL 14 HOUR + INTERVAL 5 MINUTE, '%B %d, %Y, %I:%M %p') WHEN 2 THEN 'N/A' ELSE 'later' END AS scraped_at
FROM orders
""")
def pretty_dates(table, spark):
    place = F.col("o_orderkey") % 5
    day, end = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format(F.date_add(F.to_date("o_orderdate"), 3), "yyyy-MM-dd")
    event = pick(place, day, F.concat(day, F.lit(" to "), end), F.lit("N/A"), F.lit("2023-02-31"), F.lit("next week"))
    scraped = pick(place, F.concat(day, F.lit("T14:05:09Z")), F.concat(day, F.lit("T14:05:09.123456+00:00")), F.lit(""), F.lit("later"), F.lit("later"))
    return table("orders").select("o_orderkey", times.pretty_event_date(event).alias("event_date"), times.pretty_timestamp(scraped).alias("scraped_at"))


TIERS = {"lgu": 8, "major": 5, "quiet": 3}
TIER_SQL = "CASE user_id % 4 WHEN 0 THEN 'lgu' WHEN 1 THEN 'major' WHEN 2 THEN 'quiet' ELSE 'other' END"


@query("tier_topk", f"""
WITH r AS (SELECT event_id, user_id, {TIER_SQL} AS tier, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rank FROM events)
SELECT event_id, user_id, tier, rank FROM r WHERE rank <= CASE tier WHEN 'lgu' THEN 8 WHEN 'major' THEN 5 ELSE 3 END
""")
def tier_topk(table, spark):
    kinds = F.array(*[F.lit(t) for t in ("lgu", "major", "quiet", "other")])
    work = table("events").select("event_id", "user_id", "ts", F.get(kinds, (F.col("user_id") % 4).cast("int")).alias("tier"))
    limits, _ = topk.sweep_limits("strong")
    out = topk.first_n_by_tier(work, ["user_id"], [F.desc("ts"), F.col("event_id")], F.col("tier"), limits)
    return out.select("event_id", "user_id", "tier", F.col("rank").cast("bigint").alias("rank"))


@query("sweep_costs", """
SELECT mode, CAST(sum(n) AS BIGINT) AS expected_posts, CAST(sum(n) * 0.005 AS DOUBLE) AS estimated_cost FROM (
  SELECT mode, CASE s_suppkey % 3 WHEN 0 THEN lgu WHEN 1 THEN major ELSE quiet END AS n FROM supplier,
    (VALUES ('strong', 8, 5, 3), ('medium', 4, 2, 2), ('light', 2, 1, 1), ('unknown', 4, 2, 2)) AS m(mode, lgu, major, quiet)) GROUP BY 1
""")
def sweep_costs(table, spark):
    kinds = F.array(*[F.lit(t) for t in ("lgu", "major", "quiet")])
    pages = table("supplier").select(F.get(kinds, (F.col("s_suppkey") % 3).cast("int")).alias("tier"))
    out = topk.cost_table(pages, ["strong", "medium", "light", "unknown"])
    return out.withColumn("estimated_cost", F.round("estimated_cost", 6))


@query("pages_by_limit", """
SELECT CASE s_suppkey % 3 WHEN 0 THEN 8 WHEN 1 THEN 5 ELSE 3 END AS post_limit, count(*) AS pages, min(s_name) AS first_url, max(s_name) AS last_url
FROM supplier GROUP BY 1
""")
def pages_by_limit(table, spark):
    kinds = F.array(*[F.lit(t) for t in ("lgu", "major", "quiet")])
    pages = table("supplier").select("s_name", F.get(kinds, (F.col("s_suppkey") % 3).cast("int")).alias("tier"))
    return topk.pages_by_limit(pages, TIERS, url="s_name")


@query("batch_filter", """
SELECT 'some' AS asked, c_custkey FROM customer WHERE upper(c_mktsegment) IN ('MACHINERY', 'FURNITURE')
UNION ALL SELECT 'none', c_custkey FROM customer UNION ALL SELECT 'all', c_custkey FROM customer
""")
def batch_filter(table, spark):
    customers = table("customer").select("c_custkey", "c_mktsegment")
    parts = [("some", " machinery, Furniture,"), ("none", "x,y"), ("all", "ALL")]
    out = None
    for name, wanted in parts:
        kept = topk.in_batches(customers, wanted, "c_mktsegment").select(F.lit(name).alias("asked"), "c_custkey")
        out = kept if out is None else out.unionByName(kept)
    return out


@query("budget_cap", """
SELECT conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) <= 25 AS within_budget FROM conversations
""")
def budget_cap(table, spark):
    rows = table("conversations").select("conv_id", "turn", "role")
    return topk.budget(rows, ["role"], ["conv_id", "turn"]).select("conv_id", "turn", "within_budget")


@query("json_struct", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CASE event_type WHEN 'view' THEN 'academic' WHEN 'click' THEN 'lgu' END AS category,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Event ' || event_id END AS event_name, event_id % 2 = 0 AS is_cancellation FROM events
""")
def json_struct(table, spark):
    kind = F.when(F.col("event_type") == "view", "academic").when(F.col("event_type") == "click", "lgu").when(
        F.col("event_type") == "error", "NULL").otherwise("other")
    name = F.when(F.col("event_id") % 3 == 0, F.get(F.array(F.lit("None"), F.lit("N/A"), F.lit("")), F.pmod(F.floor(F.col("event_id") / 3), F.lit(3)).cast("int"))
                  ).otherwise(F.concat(F.lit("Event "), "event_id"))
    answer = F.to_json(F.struct(kind.alias("category"), name.alias("event_name"), F.when(F.col("event_id") % 2 == 0, True).alias("is_cancellation")))
    parsed = table("events").select("event_id", F.from_json("props", "k int")["k"].alias("k"), nested.parse_answer(answer).alias("a"))
    return parsed.select("event_id", "k", "a.category", "a.event_name", "a.is_cancellation")


@query("media_uris", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'img' || user_id WHEN 1 THEN 'thumb' || user_id WHEN 2 THEN 'http://x/' || user_id END AS uri,
  CASE event_id % 3 WHEN 0 THEN 'own ' || event_id WHEN 1 THEN 'shared ' || event_id ELSE '' END AS caption FROM events
""")
def media_uris(table, spark):
    place, user = F.col("event_id") % 4, F.col("user_id").cast("string")
    item = F.struct(
        F.when(place == 0, F.struct(F.concat(F.lit("img"), user).alias("uri"))).alias("photo_image"),
        F.when(place == 1, F.concat(F.lit("thumb"), user)).alias("thumbnail"),
        F.when(place == 2, F.concat(F.lit("http://x/"), user)).when(place == 3, F.lit("https://www.facebook.com/photo/1")).alias("url"),
        F.lit(None).cast("string").alias("ocrText"),
    )
    uris = nested.media_uris(F.array(item).cast(nested.MEDIA_TYPE))
    own = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("own "), "event_id")).otherwise("")
    shared = F.when(F.col("event_id") % 3 == 1, F.concat(F.lit("shared "), "event_id"))
    none = F.lit(None).cast("string")
    return table("events").select("event_id", F.get(uris, F.lit(0)).alias("uri"), nested.caption(own, none, shared, none).alias("caption"))


@query("weather_payloads", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, round(max(value), 2) AS hi FROM events GROUP BY ALL),
a AS (SELECT user_id, list(strftime(day, '%Y-%m-%d') ORDER BY day) AS days, list(hi ORDER BY day) AS his FROM d GROUP BY 1)
SELECT user_id, user_id % 2 = 0 AS is_primary, his[1] AS temperature, days[1] || CASE WHEN user_id % 2 = 0 THEN 'T05:00+08:00' ELSE 'T13:00:00+08:00' END AS observed_at,
  days[i + 1] AS forecast_date, his[i + 1] AS temp_max
FROM (SELECT *, unnest(range(1, least(7, len(days) - 1) + 1)) AS i FROM a)
""")
def weather_payloads(table, spark):
    daily = table("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.round(F.max("value"), 2).alias("hi"))
    packed = _first_days(daily, "hi")
    day, hi = (lambda x: F.date_format(x["day"], "yyyy-MM-dd")), (lambda x: x["hi"])
    primary = F.to_json(F.struct(
        F.struct(F.concat(day(F.col("d")[0]), F.lit("T05:00")).alias("time"), F.col("d")[0]["hi"].alias("temperature_2m")).alias("current"),
        F.struct(F.transform("d", day).alias("time"), F.transform("d", hi).alias("temperature_2m_max")).alias("daily"),
    ))
    secondary = F.to_json(F.struct(
        F.array(F.struct(F.col("d")[0]["hi"].cast("string").alias("temp_C"))).alias("current_condition"),
        F.transform("d", lambda x: F.struct(day(x).alias("date"), x["hi"].cast("string").alias("maxtempC"))).alias("weather"),
    ))
    at = F.to_timestamp(F.concat(day(F.col("d")[0]), F.lit(" 05:30:00")))
    texts = packed.select(
        "user_id", (F.col("user_id") % 2 == 0).alias("is_primary"), F.when(F.col("user_id") % 2 == 0, primary).alias("primary"),
        F.when(F.col("user_id") % 2 != 0, secondary).alias("secondary"), feeds.local_hour(at).alias("hour"))
    read = feeds.parse_weather(texts, ("primary", "secondary"), F.col("hour"))
    return read.select("user_id", "is_primary", "weather.current.temperature", "weather.current.observed_at", F.explode("weather.forecasts").alias("f")).select(
        "user_id", "is_primary", "temperature", "observed_at", "f.forecast_date", "f.temp_max")


@query("weather_refresh", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, round(max(value), 2) AS hi FROM events GROUP BY ALL),
a AS (SELECT user_id, list(hi ORDER BY day) AS his, user_id >= 20 AND user_id % 3 = 0 AS fresh FROM d GROUP BY 1),
s AS (SELECT *, last_value(CASE WHEN fresh THEN user_id END IGNORE NULLS) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS src FROM a),
r AS (SELECT s.user_id, CASE WHEN s.fresh THEN 'fresh' WHEN src IS NOT NULL THEN 'neighbour' WHEN s.user_id % 2 = 0 THEN 'stored' ELSE 'constant' END AS fallback_level,
  CASE WHEN src IS NOT NULL THEN f.his[1] WHEN s.user_id % 2 = 0 THEN s.user_id * 1.0::DOUBLE ELSE 28.5::DOUBLE END AS temperature,
  CASE WHEN src IS NOT NULL THEN round(f.his[1] / 10, 3) ELSE 0.0::DOUBLE END AS rainfall_mm FROM s LEFT JOIN a f ON f.user_id = s.src)
SELECT *, CASE WHEN rainfall_mm > 30 THEN 'Red' WHEN rainfall_mm >= 15 THEN 'Orange' WHEN rainfall_mm >= 7.5 THEN 'Yellow' ELSE 'None' END AS computed_rainfall_level FROM r
""")
def weather_refresh(table, spark):
    return _refresh(table)[0].select(
        F.col("station").cast("bigint").alias("user_id"), "fallback_level", "temperature", "rainfall_mm", "computed_rainfall_level")


@query("weather_refresh_slots", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, round(max(value), 2) AS hi FROM events GROUP BY ALL),
a AS (SELECT user_id, list(hi ORDER BY day) AS his, list(strftime(day, '%Y-%m-%d') ORDER BY day) AS days, user_id >= 20 AND user_id % 3 = 0 AS fresh FROM d GROUP BY 1),
s AS (SELECT *, last_value(CASE WHEN fresh THEN user_id END IGNORE NULLS) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS src FROM a)
SELECT 'FCT-U' || s.user_id || '-' || printf('%04d', i) AS id, f.days[i + 1] AS forecast_date, f.his[i + 1] AS temp_max
FROM s JOIN (SELECT *, unnest(range(1, least(7, len(days) - 1) + 1)) AS i FROM a) f ON f.user_id = s.src
""")
def weather_refresh_slots(table, spark):
    return _refresh(table)[1].select("id", "forecast_date", "temp_max")


def _refresh(table):
    from railtide.plans import weather

    return weather.refresh(*_stations(table), now())


def _stations(table):
    """Users as stations: some report, the others fall back on a neighbour, a stored row or constants."""
    daily = table("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.round(F.max("value"), 2).alias("hi"))
    packed = _first_days(daily, "hi")
    first = F.col("d")[0]
    payload = F.to_json(F.struct(
        F.struct(F.concat(F.date_format(first["day"], "yyyy-MM-dd"), F.lit("T05:00")).alias("time"), first["hi"].alias("temperature_2m"),
                 F.round(first["hi"] / 10, 3).alias("precipitation")).alias("current"),
        F.struct(F.transform("d", lambda x: F.date_format(x["day"], "yyyy-MM-dd")).alias("time"),
                 F.transform("d", lambda x: x["hi"]).alias("temperature_2m_max")).alias("daily"),
    ))
    user = F.col("user_id")
    text = packed.select(
        user.cast("string").alias("station"), F.when((user >= 20) & (user % 3 == 0), payload).alias("primary"), F.lit(None).cast("string").alias("secondary"))
    users = table("events").select("user_id").distinct()
    stations = users.select(user.cast("string").alias("station"), F.concat(F.lit("U"), user).alias("code"), user.alias("station_seq"))
    stored = users.where("user_id % 2 = 0").select(
        user.cast("string").alias("station"), user.cast("double").alias("temperature"), *[
            F.lit(None).cast("double").alias(v) for v in ("humidity", "rainfall_mm", "wind_speed")])
    return stations, text, stored


REFRESH_SQL = """
d AS (SELECT user_id, CAST(ts AS DATE) AS day, round(max(value), 2) AS hi FROM events GROUP BY ALL),
a AS (SELECT user_id, list(hi ORDER BY day) AS his, list(strftime(day, '%Y-%m-%d') ORDER BY day) AS days, user_id >= 20 AND user_id % 3 = 0 AS fresh FROM d GROUP BY 1),
s AS (SELECT *, last_value(CASE WHEN fresh THEN user_id END IGNORE NULLS) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS src FROM a)"""


@query("weather_store", f"""
WITH {REFRESH_SQL}
SELECT s.user_id, CASE WHEN src IS NOT NULL THEN f.his[1] ELSE s.user_id * 1.0::DOUBLE END AS temperature,
  CASE WHEN src IS NOT NULL THEN round(f.his[1] / 10, 3) ELSE 0.0::DOUBLE END AS rainfall_mm,
  '2024-02-01T00:00:00+00:00' AS fetched_at
FROM s LEFT JOIN a f ON f.user_id = s.src WHERE s.user_id % 2 = 0
""")
def weather_store(table, spark):
    """The stored snapshot after the job has run twice."""
    return _stored_run(table, spark)[0].select(F.col("station").cast("bigint").alias("user_id"), "temperature", "rainfall_mm", "fetched_at")


@query("weather_store_slots", f"""
WITH {REFRESH_SQL},
f AS (SELECT 'FCT-U' || s.user_id || '-' || printf('%04d', i) AS id, f.days[i + 1] AS forecast_date, f.his[i + 1] AS temp_max
  FROM s JOIN (SELECT *, unnest(range(1, least(7, len(days) - 1) + 1)) AS i FROM a) f ON f.user_id = s.src),
o AS (SELECT 'FCT-U' || user_id || '-' || printf('%04d', i) AS id FROM s, (SELECT unnest(range(1, 6)) AS i) WHERE user_id % 2 = 0)
SELECT o.id, f.forecast_date, f.temp_max FROM o LEFT JOIN f ON f.id = o.id
""")
def weather_store_slots(table, spark):
    """The stored forecast slots after the job has run twice: slots that no run fills stay as they are."""
    return _stored_run(table, spark)[1].select("id", "forecast_date", "temp_max")


def _stored_run(table, spark):
    import uuid

    from railtide.operators import nested
    from railtide.plans import weather
    from railtide.session import ensure_checkpoint_dir
    from railtide.sinks import tables

    stations, text, stored = _stations(table)
    folder = f"{ensure_checkpoint_dir(spark)}/weather-{uuid.uuid4().hex}"
    current, slots = f"{folder}/current", f"{folder}/forecasts"
    tables.replace_table(stored.withColumn("fetched_at", F.lit(None).cast("string")), current)
    tables.replace_table(
        stations.where("station_seq % 2 = 0").select("station", "code", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("slot"))
        .select(nested.slot_id(F.col("code"), F.col("slot")).alias("id"), "station", F.lit(None).cast("string").alias("forecast_date"),
                F.lit(None).cast("double").alias("temp_max")), slots)
    for _ in range(2):
        weather.store_refresh(stations, text, current, slots, now())
    return tables.read_table(spark, current), tables.read_table(spark, slots)


@query("watchdog_audit", f"""
WITH s AS (SELECT user_id, max(ts) AS seen FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT u.user_id, CASE WHEN u.user_id % 2 = 0 THEN 21.5::DOUBLE ELSE 28.5::DOUBLE END AS temperature,
  CASE WHEN u.user_id % 2 = 0 THEN 'fresh' ELSE 'constant' END AS fallback_level
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN s USING (user_id)
WHERE coalesce((epoch_us({NOW_SQL}) - epoch_us(seen)) / 6e7 > 7200, true)
""")
def watchdog_audit(table, spark):
    from railtide.plans import weather

    user = F.col("user_id").cast("string").alias("station")
    stations = table("events").select(user).distinct()
    seen = table("events").where("event_type = 'error'").select(user, F.col("ts").alias("fetched_at"), F.col("ts").alias("observed_at"))
    answer = F.to_json(F.struct(F.array(F.struct(F.lit("21.5").alias("temp_C"))).alias("current_condition")))
    payloads = table("events").select("user_id").distinct().select(
        user, F.lit("[]").alias("primary"), F.when(F.col("user_id") % 2 == 0, answer).alias("secondary"))
    out = weather.watchdog(stations, seen, payloads, now(), 7200.0)
    return out.select(F.col("station").cast("bigint").alias("user_id"), "temperature", "fallback_level")
