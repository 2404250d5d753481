"""Queries on announcements: tags, friction, cancellations, digests, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules
from railtide.plans import posts
from railtide.operators import ids, nested, tagging
from railtide.registry.base import NOW, SQL, one_of, pick, query
from railtide.registry.texts import CLEAN_SQL, TEXT_KEY
from railtide.session import cut_lineage, spread
from railtide.streaming import events as streams

RULES = [
    ("CIVIC_MAINTENANCE", ["token", "copyright"], [], 1),
    ("TRANSPORT_STRIKE", ["estion", "queque"], ["worthless"], 2),
    ("RESUMPTION_CLASSES", ["enlich", "osci"], [], 3),
    ("WEATHER_ADVISORY", ["tion"], ["pour"], 4),
]
CANCEL, QUIET = ["haon", "heit"], ["ndat", "eaux"]
FOLD = "replace(lower(strip_accents(text)), 'ß', 'ss')"
CODE_SQL = "CASE " + " ".join(
    f"WHEN {one_of(inc, 't')}" + (f" AND NOT {one_of(exc, 't')}" if exc else "") + f" THEN '{code}'" for code, inc, exc, _ in RULES
) + " END"


NOTICES = ["classes suspended, concert cancelled", "suspended classes lifted", "walang pasok bukas: all classes cancelled due to typhoon",
           "midterms cancelled", ""]
NOTICE_SQL = "[" + ", ".join(f"'{n}'" for n in NOTICES) + "][(doc_id % 5 + 1)::INT]"


@query("rule_tagger", f"""
WITH d AS (SELECT doc_id, {NOTICE_SQL} || ' ' || {FOLD} AS t FROM documents),
c AS (SELECT doc_id, t, CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 'CLASS_SUSPENSION' WHEN doc_id % 5 = 3 THEN 'EXAM_WEEK' ELSE {CODE_SQL} END AS event_code FROM d),
x AS (SELECT *, coalesce(event_code <> 'CIVIC_MAINTENANCE' AND CASE WHEN event_code = 'CLASS_SUSPENSION' THEN {one_of(vocab.SUSPENSION_LIFT_WORDS, 't')}
  ELSE {one_of(CANCEL + vocab.CANCEL_WORDS, 't')} END, false) AS is_cancellation FROM c)
SELECT doc_id, event_code, is_cancellation,
  CASE WHEN is_cancellation THEN CASE event_code WHEN 'RESUMPTION_CLASSES' THEN 'CLASS_SUSPENSION' ELSE event_code END END AS cancellation_target_code,
  event_code IS NOT NULL AND NOT {one_of(QUIET, 't')} AS affects_ridership FROM x
""")
def rule_tagger(table, spark):
    """Invented rule words of the texts, with real notices before them, which have the first say."""
    notice = pick(F.col("doc_id") % 5, *[F.lit(n) for n in NOTICES])
    work = spread(table("documents")).select("doc_id", F.concat(notice, F.lit(" "), rules.folded(F.col("text"))).alias("t"))
    real = [r for r in vocab.EVENT_CODE_RULES if r[0] in ("CLASS_SUSPENSION", "EXAM_WEEK")]
    later = [(code, words, vetoes, place + 100) for code, words, vetoes, place in RULES]
    return tagging.tag_events(work, F.col("t"), real + later, CANCEL + vocab.CANCEL_WORDS, QUIET).drop("t")


GROUPS = {"full_suspension": ["token"], "transport_strike": ["estion"], "partial_suspension": ["queque"],
          "arena_event": ["enlich", "osci"], "train_degradation": ["tion"]}


@query("friction_weight", f"""
WITH d AS (SELECT doc_id, {FOLD} AS t FROM documents)
SELECT doc_id, CASE WHEN {one_of(GROUPS['full_suspension'], 't')} THEN 1.0::DOUBLE WHEN {one_of(GROUPS['transport_strike'], 't')} THEN 0.9::DOUBLE
  WHEN {one_of(GROUPS['partial_suspension'], 't')} THEN 0.85::DOUBLE WHEN {one_of(GROUPS['arena_event'], 't')} THEN 0.65::DOUBLE
  WHEN {one_of(GROUPS['train_degradation'], 't')} THEN 0.5::DOUBLE END AS weight FROM d
""")
def friction_weight(table, spark):
    work = spread(table("documents")).select("doc_id", rules.folded(F.col("text")).alias("t"))
    return work.select("doc_id", tagging.friction_weight(F.col("t"), GROUPS).alias("weight"))


@query("friction_by_hit", """
SELECT e.user_id, max(p_size / 50.0::DOUBLE) AS friction_weight FROM events e JOIN part ON p_partkey = e.event_id % 200 GROUP BY 1
""")
def friction_by_hit(table, spark):
    hits = table("events").select("user_id", (F.col("event_id") % 200).alias("keyword_group"))
    weights = table("part").select(F.col("p_partkey").alias("keyword_group"), (F.col("p_size") / 50.0).alias("weight"))
    return tagging.friction_by_hit(hits, weights, key="user_id")


@query("cancellation", """
WITH e AS (SELECT event_id, user_id AS source_name, event_type AS event_code, event_id % 17 = 0 AS is_cancellation,
  CASE WHEN event_id % 17 = 0 THEN CASE WHEN event_type = 'view' THEN 'click' ELSE event_type END END AS target, ts FROM events)
SELECT event_id, is_cancellation OR NOT EXISTS (SELECT 1 FROM e c WHERE c.is_cancellation AND c.source_name = e.source_name AND c.target = e.event_code AND c.ts > e.ts) AS is_active FROM e
""")
def cancellation(table, spark):
    cancels = F.col("event_id") % 17 == 0
    target = F.when(F.col("event_type") == "view", "click").otherwise(F.col("event_type"))
    work = table("events").select(
        "event_id", F.col("user_id").alias("source_name"), F.col("event_type").alias("event_code"), cancels.alias("is_cancellation"),
        F.when(cancels, target).alias("cancellation_target_code"), F.col("ts").alias("post_date"))
    return tagging.cancel_earlier(work).select("event_id", "is_active")


@query("digest", """
SELECT user_id % 3 AS batch, CASE event_type WHEN 'view' THEN 'Academic' WHEN 'click' THEN 'LGU' WHEN 'error' THEN 'Academic Calendar' ELSE upper(event_type[1]) || event_type[2:] END AS category,
  count(*) AS new_events FROM events GROUP BY ALL
""")
def digest(table, spark):
    kind = F.col("event_type")
    category = F.when(kind == "view", "academic").when(kind == "click", "lgu").when(kind == "error", "academic_calendar").otherwise(kind)
    work = table("events").select((F.col("user_id") % 3).alias("batch"), rules.category_label(category).alias("category"))
    return tagging.digest_counts(work)


@query("digest_rows", """
SELECT 'User ' || user_id AS source_name, CASE WHEN user_id % 2 = 0 THEN 'N/A' ELSE 'st' || user_id END AS station, 'b' || (user_id % 3) AS batch,
  CASE event_type WHEN 'view' THEN 'Academic' ELSE 'N/A' END AS category, CASE WHEN event_id % 2 = 0 THEN 'N/A' ELSE event_type END AS event_name,
  strftime(ts, '%B %d, %Y') AS event_date, 'http://x/' || event_id AS url FROM events
""")
def digest_rows(table, spark):
    user = F.col("user_id")
    work = table("events").select(
        F.concat(F.lit("User "), user).alias("source_name"), F.when(user % 2 != 0, F.concat(F.lit("st"), user)).alias("station"),
        F.concat(F.lit("b"), user % 3).alias("batch"), F.when(F.col("event_type") == "view", "academic").alias("category"),
        F.when(F.col("event_id") % 2 != 0, F.col("event_type")).otherwise("").alias("event_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("event_date"), F.concat(F.lit("http://x/"), "event_id").alias("url"))
    return tagging.digest_rows(work)


def _folder(spark, name: str) -> str:
    """A folder of its own for stream state, beside the checkpoints; Spark's writers make it."""
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _in_runs(table, spark, name: str, run_of, columns, step):
    """Runs a stream over the events three times, each time with one more part of them; returns its folder.

    ``run_of`` says in which run a row arrives; ``step`` takes (stream, folder of its own).
    """
    path = _folder(spark, name)
    parts = cut_lineage(table("events").select(*columns, run_of.alias("_run")))
    for run in range(3):
        parts.where(F.col("_run") == run).drop("_run").write.mode("append").parquet(f"{path}/in")
        step(streams.read_stream(spark, f"{path}/in", parts.drop("_run").schema), path)
    return path


def _run_by_id():
    """Events arrive in three runs by their id."""
    return F.col("event_id") % 3


@query("stream_dedupe", """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3, event_id) AS rn FROM events)
SELECT event_id, user_id, event_type FROM e WHERE rn = 1
""")
def stream_dedupe(table, spark):
    def step(stream, path):
        streams.first_row_stream(stream, ["user_id", "event_type"], "event_id", f"{path}/table", f"{path}/progress")

    path = _in_runs(table, spark, "stream-dedupe", _run_by_id(), ["event_id", "user_id", "event_type"], step)
    return streams.read_batches(spark, f"{path}/table")


@query("stream_snapshot", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def stream_snapshot(table, spark):
    key, order = ["user_id"], ["ts", "event_id"]

    def step(stream, path):
        streams.snapshot_stream(stream, key, order, f"{path}/table", f"{path}/progress")

    path = _in_runs(table, spark, "stream-snapshot", _run_by_id(), ["user_id", "ts", "event_id", "event_type"], step)
    return streams.read_snapshot(spark, f"{path}/table", key, order).select("user_id", "event_id", "event_type")


# ends of the first and second third of the time the events span, as both engines compute them
SPAN_SQL = """span AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // 3 AS third FROM events),
timed AS (SELECT e.*, epoch_us(ts) AS us, least(2, (epoch_us(ts) - lo) // greatest(third, 1)) AS by_time FROM events e, span)"""


def _run_by_time(table):
    """In which third of the time span an event lies."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = table("events").agg(F.min(micros), F.max(micros)).first()
    third = max(((high or 0) - (low or 0)) // 3, 1)
    return F.least(F.lit(2), F.floor((micros - F.lit(low)) / F.lit(third))).cast("int")


@query("late_data", f"""
WITH {SPAN_SQL},
arriving AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE us // 1000 END AS ms, us,
    CASE WHEN event_id % 11 = 0 THEN 2 ELSE by_time END AS run, event_id % 13 = 0 AS untimed FROM timed),
marks AS (SELECT r.run, coalesce((SELECT max(a.ms) - 3600000 FROM arriving a WHERE a.run < r.run), -1) AS mark FROM (VALUES (0), (1), (2)) r(run))
SELECT event_id, CASE WHEN untimed AND event_id % 7 = 0 AND run < 2 THEN 2 ELSE 1 END AS n
FROM arriving JOIN marks USING (run) WHERE untimed OR us > mark * 1000
""")
def late_data(table, spark):
    """Rows of unknown time, rows that come hours late, and rows that come again with the next run."""
    event = F.col("event_id")
    when_known = F.when(event % 13 != 0, F.col("ts").cast("timestamp"))
    run = F.when(event % 11 == 0, 2).otherwise(_run_by_time(table))
    both = table("events").select("event_id", when_known.alias("ts"), run.alias("run"))
    again = both.where((event % 7 == 0) & (F.col("run") < 2)).withColumn("run", F.col("run") + 1)
    arriving = both.unionByName(again)

    def step(stream, path):
        rows = streams.first_within_or_untimed(stream, ["event_id"], "ts", "1 hour")
        streams.run_available(rows, streams.write_batch(f"{path}/table"), f"{path}/progress", counted=False)

    path = _in_runs(lambda _: arriving, spark, "late-data", F.col("run"), ["event_id", "ts"], step)
    return streams.read_batches(spark, f"{path}/table").groupBy("event_id").agg(F.count("*").alias("n"))


ALERT_MINUTES = 24 * 60.0


@query("staleness_stream", f"""
WITH e AS (SELECT user_id, epoch_us(ts) AS us, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS next_us FROM events),
last AS (SELECT max(epoch_us(ts)) // 1000 AS ms FROM events)
SELECT user_id, us AS last_seen_us FROM e, last
WHERE next_us - us > {int(ALERT_MINUTES * 60_000_000)} OR (next_us IS NULL AND (us + {int(ALERT_MINUTES * 60_000_000)}) // 1000 < ms)
""")
def staleness_stream(table, spark):
    def step(stream, path):
        alerts = streams.staleness_alerts(stream, "user_id", "ts", ALERT_MINUTES, "0 seconds")
        streams.run_available(alerts, streams.write_batch(f"{path}/table"), f"{path}/progress")

    columns = ["user_id", F.col("ts").cast("timestamp").alias("ts")]
    path = _in_runs(table, spark, "staleness", _run_by_time(table), columns, step)
    return streams.read_batches(spark, f"{path}/table").select("user_id", F.unix_micros("last_seen").alias("last_seen_us"))


@query("sweep_windows", """
WITH e AS (SELECT event_type, ts FROM events),
w AS (SELECT event_type, to_timestamp(28800 * (CAST(floor(epoch_us(ts) / 28800000000.0) AS BIGINT) - k)) AT TIME ZONE 'UTC' AS s
  FROM e, (VALUES (0), (1), (2)) AS o(k))
SELECT event_type, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM w GROUP BY ALL
""")
def sweep_windows(table, spark):
    out = streams.sweep_counts(table("events"), "ts", "24 hours", "8 hours", ["event_type"])
    return out.select("event_type", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


# words that the invented prose holds
WORDS = {
    "academic": ["estion", "enlich", "queque", "handed"],
    "lgu": ["ndat", "haon", "osci"],
    "always_lgu": ["token", "copyright", "edonble"],
    "context": ["of the", "der", "pour"],
}
SWEEP_KEY = TEXT_KEY.replace("text,", "c || ' ',")


@query("posts_sweep", f"""
WITH RECURSIVE pages AS (
  SELECT source, row_number() OVER (ORDER BY source) - 1 AS seq, 'https://www.facebook.com/' || source AS url FROM documents GROUP BY 1),
items AS (
  SELECT d.doc_id, d.text, 'https://www.facebook.com/' || d.source AS asked, TIMESTAMP '{NOW}' - to_hours(CAST(d.doc_id % 30 AS BIGINT)) AS posted FROM documents d),
placed AS (
  SELECT i.*, (SELECT min(p.seq) FROM pages p WHERE contains(i.asked, p.url) OR contains(p.url, i.asked)) AS seq FROM items i
  WHERE i.doc_id % 30 <= 24),
ranked AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY posted DESC, doc_id) AS rn FROM placed),
newest AS (SELECT * FROM ranked WHERE rn <= CASE seq % 3 WHEN 0 THEN 8 WHEN 1 THEN 5 ELSE 3 END),
cleaned AS (SELECT doc_id, seq, {CLEAN_SQL} AS c FROM newest),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq, c ORDER BY doc_id) AS n FROM cleaned WHERE c <> '') WHERE n = 1),
gated AS (
  SELECT *, CASE WHEN {one_of(WORDS['always_lgu'], 'lower(c)')} THEN 'lgu' WHEN {one_of(WORDS['academic'], 'lower(c)')} AND {one_of(WORDS['context'], 'lower(c)')} THEN 'academic'
    WHEN NOT {one_of(WORDS['academic'], 'lower(c)')} AND {one_of(WORDS['lgu'], 'lower(c)')} THEN 'lgu' END AS gate FROM once),
k AS (
  SELECT row_number() OVER (ORDER BY seq, doc_id) AS n, doc_id, CASE WHEN seq % 2 = 0 THEN 'academic' ELSE 'lgu' END AS category,
    hash('t', {SWEEP_KEY}) AS a, hash('e', seq, length(c) % 40, length(replace(c, 'e', '')) % 10) AS b
  FROM gated WHERE gate IS NOT NULL),
walk(n, kept, held) AS (
  SELECT CAST(0 AS BIGINT), false, CAST([] AS UBIGINT[])
  UNION ALL
  SELECT k.n, NOT list_has_any(w.held, [k.a, k.b]),
    CASE WHEN list_has_any(w.held, [k.a, k.b]) THEN w.held ELSE list_concat(w.held, list_filter([k.a, k.b], lambda x: x IS NOT NULL)) END
  FROM walk w JOIN k ON k.n = w.n + 1)
SELECT 'external_' || CASE category WHEN 'academic' THEN 'acad' ELSE 'lgu' END || '_' || printf('%04d', row_number() OVER (PARTITION BY category ORDER BY k.n)) AS id,
  category, k.doc_id FROM walk w JOIN k ON k.n = w.n WHERE w.kept
""".strip())
def posts_sweep(table, spark):
    """The posts job over documents: sources are pages, texts are captions."""
    items, pages, options = _sweep(table)
    run = posts.run_posts(items, pages, None, **options)
    return run.events.select("id", "category", F.element_at(F.split("source_url", "/"), -1).cast("bigint").alias("doc_id"))


@query("posts_store", SQL["posts_sweep"])
def posts_store(table, spark):
    """The stored events after two sweeps over the same posts: the second finds all of them by their keys."""
    items, pages, options = _sweep(table)
    path = _folder(spark, "events")
    for _ in range(2):
        posts.store_posts(items, pages, path, **options)
    return posts.active_events(spark, path).where("is_active").select(
        "id", "category", F.element_at(F.split("source_url", "/"), -1).cast("bigint").alias("doc_id"))


def _sweep(table):
    """(items, pages, options) of a sweep over documents."""
    none = F.lit(None).cast("string")
    docs = table("documents")
    base = F.lit("https://www.facebook.com/")
    names = docs.select("source").distinct()
    # pages are numbered by name
    numbered = ids.number_rows(names, ["source"], "place").select((F.col("place") - 1).alias("seq"), "source")
    seq = F.col("seq")
    pages = numbered.select(
        seq.cast("bigint").alias("page_seq"), F.lit("b").alias("batch"), F.lit("st").alias("station"), F.col("source").alias("name"),
        F.when(seq % 2 == 0, "academic").otherwise("lgu").alias("source_type"),
        F.when(seq % 3 == 0, "lgu").when(seq % 3 == 1, "major").otherwise("quiet").alias("tier"), F.concat(base, "source").alias("url"))
    at = F.lit(NOW).cast("timestamp")
    items = docs.select(
        F.concat(base, "source").alias("asked_url"), none.alias("page_name"), F.concat(base, "source", F.lit("/posts/"), "doc_id").alias("source_url"),
        F.timestamp_seconds(F.unix_seconds(at) - (F.col("doc_id") % 30) * 3600).alias("posted_at"), F.col("text").alias("raw_text"),
        F.array().cast(nested.MEDIA_TYPE).alias("media"), F.col("doc_id").alias("item_seq"))

    # counts over the whole text name an event, so that different posts now and then name the same one
    name = F.concat_ws(" ", F.lit("event"), F.length("text") % 40, F.length(F.replace("text", F.lit("e"), F.lit(""))) % 10)

    def classify(gated):
        return gated.withColumns({
            "answer_category": F.col("_gate"), "event_name": name, "event_date": none, "event_code": none,
            "is_cancellation": F.lit(False), "cancellation_target_code": none, "answer_failed": F.lit(False)})

    return items, pages, {"now": at, "mode": "strong", "classify": classify, "groups": WORDS}
