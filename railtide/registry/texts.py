"""Queries on texts and URLs: cleaning, matching, keys, dedupe."""

from __future__ import annotations

from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules, text, urls
from railtide.operators import dedupe, diagnostics, match
from railtide.registry.base import one_of, pick, query, seeded, seeded_sql
from railtide.session import cut_lineage, spread

FOLD = "replace(lower(strip_accents(text)), 'ß', 'ss')"


@query("unicode_norm", f"""
SELECT doc_id, md5(strip_accents(text)) AS normal_md5, md5({FOLD}) AS folded_md5, length({FOLD}) AS folded_chars FROM documents
""")
def unicode_norm(table, spark):
    work = spread(table("documents")).select("doc_id", text.normalize_unicode(F.col("text")).alias("n"))
    folded = text.casefold(F.col("n"))
    return work.select(
        "doc_id", F.md5("n").alias("normal_md5"), F.md5(folded).alias("folded_md5"),
        F.length(folded).cast("bigint").alias("folded_chars"),
    )


# each text gets words of the real lists, which the invented prose lacks: one of three lists by the
# text's id, and for some texts a second one
GATE = rules.DEFAULT_GROUPS
GATE_SEEDS = [
    (3, 0, vocab.CLASS_SUSPENSION + vocab.ACADEMIC_CALENDAR + vocab.ACADEMIC_EXTRA), (3, 1, vocab.LGU_ADVISORY + vocab.LGU_EXTRA),
    (5, 2, vocab.ACADEMIC_CONTEXT), (7, 3, GATE["always_lgu"]),
]


@query("keyword_gate", f"""
WITH s AS (SELECT doc_id, {seeded_sql('text', GATE_SEEDS)} AS text FROM documents), d AS (SELECT doc_id, {FOLD} AS t FROM s)
SELECT doc_id, CASE WHEN {one_of(GATE['always_lgu'], 't')} THEN 'lgu'
  WHEN {one_of(GATE['academic'], 't')} AND {one_of(GATE['context'], 't')} THEN 'academic'
  WHEN NOT {one_of(GATE['academic'], 't')} AND {one_of(GATE['lgu'], 't')} THEN 'lgu' END AS category FROM d
""")
def keyword_gate(table, spark):
    work = spread(table("documents")).select("doc_id", rules.folded(seeded(F.col("text"), GATE_SEEDS)).alias("t"))
    return work.select("doc_id", rules.gate_category(F.col("t")).alias("category"))


@query("keyword_gate_words", """
WITH d AS (SELECT doc_id, replace(lower(strip_accents(text)), 'ß', 'ss') AS t FROM documents)
SELECT doc_id, regexp_matches(t, '(^|[^a-z0-9_])(est|of the|der)([^a-z0-9_]|$)') AS has_word,
  contains(t, 'est') OR contains(t, 'of the') OR contains(t, 'der') AS has_substring FROM d
""")
def keyword_gate_words(table, spark):
    words = ["est", "of the", "der"]
    work = spread(table("documents")).select("doc_id", rules.folded(F.col("text")).alias("t"))
    return work.select(
        "doc_id", text.contains_any(F.col("t"), words, "word").alias("has_word"),
        text.contains_any(F.col("t"), words).alias("has_substring"),
    )


CALENDAR_SEEDS = [
    (2, 0, vocab.CALENDAR_PRIMARY), (3, 0, vocab.CALENDAR_TIMEFRAME), (5, 0, vocab.CALENDAR_ACTION), (7, 0, vocab.CALENDAR_STRUCTURE),
    (4, 1, vocab.CALENDAR_NEGATIVE),
]


@query("boolean_filter", f"""
WITH s AS (SELECT doc_id, {seeded_sql('text', CALENDAR_SEEDS)} AS text FROM documents), d AS (SELECT doc_id, {FOLD} AS t FROM s),
f AS (SELECT doc_id, {one_of(vocab.CALENDAR_PRIMARY, 't')} AS p, {one_of(vocab.CALENDAR_TIMEFRAME, 't')} AS y,
  {one_of(vocab.CALENDAR_ACTION, 't')} AS a, {one_of(vocab.CALENDAR_STRUCTURE, 't')} AS s, {one_of(vocab.CALENDAR_NEGATIVE, 't')} AS n FROM d)
SELECT doc_id, p AND y AND (a OR s) AND NOT n AS is_release, p OR y AS has_hint FROM f
""")
def boolean_filter(table, spark):
    work = spread(table("documents")).select("doc_id", rules.folded(seeded(F.col("text"), CALENDAR_SEEDS)).alias("t"))
    return work.select(
        "doc_id", rules.is_calendar_release(F.col("t")).alias("is_release"), rules.has_calendar_hint(F.col("t")).alias("has_hint")
    )


RELEVANT_SEEDS = [
    (3, 0, vocab.CALENDAR_TITLES), (4, 0, vocab.CALENDAR_TITLE_ACTIONS), (7, 1, vocab.RELEVANT_STRONG),
    (2, 1, ["Suspended", "Walang", "closed", "delays", "unsuspended"]), (3, 1, vocab.SUSPENSION_CONTEXT + vocab.RELEVANT_GENERAL),
]
# the pattern as SQL engines without Unicode classes read it; folded text has no marks
SUSPENSION_SQL = r"(^|[^\p{L}\p{N}_])" + vocab.SUSPENSION_PATTERN.replace("(?iU)", "").replace(r"\b", "") + r"([^\p{L}\p{N}_]|$)"


@query("relevance_filter", f"""
WITH s AS (SELECT doc_id, {seeded_sql('text', RELEVANT_SEEDS)} AS text FROM documents), d AS (SELECT doc_id, {FOLD} AS t FROM s)
SELECT doc_id, NOT ({one_of(vocab.CALENDAR_TITLES, 't')} AND NOT {one_of(vocab.CALENDAR_TITLE_ACTIONS, 't')}) AND (
  {one_of(vocab.RELEVANT_STRONG, 't')} OR (regexp_matches(t, '{SUSPENSION_SQL}')
    AND {one_of(vocab.SUSPENSION_CONTEXT + vocab.RELEVANT_GENERAL, 't')})) AS is_relevant FROM d
""")
def relevance_filter(table, spark):
    work = spread(table("documents")).select("doc_id", rules.folded(seeded(F.col("text"), RELEVANT_SEEDS)).alias("t"))
    return work.select("doc_id", rules.is_relevant(F.col("t")).alias("is_relevant"))


@query("branch_filter", """
WITH d AS (SELECT doc_id, lower(text) AS t FROM documents)
SELECT doc_id, CASE WHEN contains(t, 'of the') OR contains(t, 'dans') THEN NOT regexp_matches(t, '(?:and|for|et)\\s+(?:(?:the|la)\\s+)?on')
  ELSE contains(t, 'heit') END AS keep FROM d
""")
def branch_filter(table, spark):
    work = spread(table("documents")).select("doc_id", F.lower("text").alias("t"))
    keep = rules.concerns_branch(F.col("t"), "heit", ["of the", "dans"], r"(?:and|for|et)\s+(?:(?:the|la)\s+)?on")
    return work.select("doc_id", keep.alias("keep"))


CLEAN_SQL = (
    "trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(trim(regexp_replace(regexp_replace(regexp_replace("
    "text, 'All reactions:.*', '', 'is'), '\\b\\d+\\s+reactions?\\b.*', '', 'is'), '\\b\\d+\\s+shares?\\b.*', '', 'is'), ' \n\t\r')), "
    "'[\\x{203C}-\\x{3299}\\x{1F300}-\\x{1FAFF}\\x{FE00}-\\x{FE0F}\\x{200D}]+', '', 'g'), "
    "'\\s*(?:See more|Tumingin pa|Read more)\\s*[.]*$', '', 'i'), '\\s+', ' ', 'g'))"
)


@query("caption_clean", f"""
SELECT 'd' || doc_id AS id, md5({CLEAN_SQL}) AS cleaned_md5, length({CLEAN_SQL}) AS cleaned_chars
FROM (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' 12 reactions and so on' WHEN 1 THEN ' ★ See more...' WHEN 2 THEN '
All reactions: 5' ELSE ' 3 shares' END AS text FROM documents)
UNION ALL
SELECT 'c' || conv_id || '-' || turn, md5({CLEAN_SQL}), length({CLEAN_SQL}) FROM conversations
""")
def caption_clean(table, spark):
    tail = pick(F.col("doc_id") % 4, *[F.lit(x) for x in (" 12 reactions and so on", " ★ See more...", "\nAll reactions: 5", " 3 shares")])
    docs = spread(table("documents")).select(F.concat(F.lit("d"), "doc_id").alias("id"), F.concat("text", tail).alias("text"))
    turns = spread(table("conversations")).select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text")
    work = docs.unionByName(turns).select("id", text.clean_caption(F.col("text")).alias("c"))
    return work.select("id", F.md5("c").alias("cleaned_md5"), F.length("c").cast("bigint").alias("cleaned_chars"))


@query("line_dedupe", """
WITH d AS (SELECT doc_id, regexp_replace(regexp_replace(strip_accents(text), '[ \t]+', ' ', 'g'), '\\s*\n\\s*', '\n', 'g') AS t FROM documents),
l AS (SELECT doc_id, i, trim(line, ' -_|•·') AS line FROM (
  SELECT doc_id, unnest(string_split(t, '\n')) AS line, generate_subscripts(string_split(t, '\n'), 1) AS i FROM d)),
k AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY i) AS rn FROM l
  WHERE length(line) >= 3 AND NOT regexp_matches(line, '(?i)(#\\w+|@\\w+|www\\.|https?://|\\.edu\\.ph|\\.gov\\.ph|\\.com\\.ph|\\.facebook\\.|f\\s*[|/]\\s*@|chooseSAN|#choose)'))
SELECT d.doc_id, md5(coalesce(string_agg(line, ' ' ORDER BY i), '')) AS cleaned_md5, count(line) AS kept_lines
FROM d LEFT JOIN k ON d.doc_id = k.doc_id AND rn = 1 GROUP BY d.doc_id
""")
def line_dedupe(table, spark):
    work = spread(table("documents")).select("doc_id", text.clean_ocr_lines(F.col("text")).alias("lines"))
    work = work.select("doc_id", text.distinct_lines(F.col("lines")).alias("lines"))
    return work.select(
        "doc_id", F.md5(F.array_join("lines", " ")).alias("cleaned_md5"), F.size("lines").cast("bigint").alias("kept_lines")
    )


@query("url_clean_key", """
WITH u AS (SELECT page_id, url, split_part(split_part(url, '&', 1), '?__cft__', 1) AS cleaned FROM pages),
p AS (SELECT *, lower(regexp_extract(cleaned, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS h,
  lower(regexp_extract(cleaned, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) AS pa,
  lower(regexp_extract(cleaned, '\\?([^#]*)', 1)) AS q FROM u)
SELECT page_id, cleaned, lower(trim(split_part(url, '?', 1))) AS bare_key,
  lower(trim(split_part(url, '?', 1))) || CASE WHEN regexp_extract(lower(regexp_extract(url, '\\?([^#]*)', 1)), '(?:^|&)(page=[^&]*)', 1) <> ''
    THEN '?' || regexp_extract(lower(regexp_extract(url, '\\?([^#]*)', 1)), '(?:^|&)(page=[^&]*)', 1) ELSE '' END AS identity_key,
  (h = 'example.com' OR ends_with(h, '.example.com')) AND NOT contains(pa, '/de/') AND NOT contains(q, 'utm_') AND regexp_matches(pa || '?' || q, '/(en|fr)/|page=') AS is_safe
FROM p
""")
def url_clean_key(table, spark):
    url = F.col("url")
    return table("pages").select(
        "page_id", urls.clean_url(url).alias("cleaned"), urls.url_key(url, ()).alias("bare_key"),
        urls.url_key(url, ("page",)).alias("identity_key"),
        urls.is_safe_post_url(url, "example.com", ["/de/"], ["utm_"], "/(en|fr)/|page=").alias("is_safe"),
    )


TEXT_KEY = "nullif(substr(replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss'), 1, 100), '')"


@query("prefix_dedupe", f"""
WITH k AS (SELECT doc_id, lang, {TEXT_KEY} AS key FROM documents)
SELECT doc_id, lang, md5(key) AS key_md5 FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS rn FROM k) WHERE rn = 1 OR key IS NULL
""")
def prefix_dedupe(table, spark):
    keyed = table("documents").select("doc_id", "lang", text.text_key(F.col("text")).alias("key"))
    return dedupe.keep_first_or_blank(keyed, "key", ["doc_id"]).select("doc_id", "lang", F.md5("key").alias("key_md5"))


@query("greedy_dedupe", f"""
WITH RECURSIVE k AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id, hash('t', {TEXT_KEY}) AS a,
    CASE WHEN n_chars % 10 <> 0 THEN hash('e', lang, n_chars) END AS b, hash('u', source, n_chars // 7) AS c FROM documents),
walk(n, kept, held) AS (
  SELECT CAST(0 AS BIGINT), false, CAST([] AS UBIGINT[])
  UNION ALL
  SELECT k.n, NOT list_has_any(w.held, [k.a, k.b, k.c]),
    CASE WHEN list_has_any(w.held, [k.a, k.b, k.c]) THEN w.held ELSE list_concat(w.held, list_filter([k.a, k.b, k.c], lambda x: x IS NOT NULL)) END
  FROM walk w JOIN k ON k.n = w.n + 1)
SELECT k.doc_id FROM walk w JOIN k ON k.n = w.n WHERE w.kept
""")
def greedy_dedupe(table, spark):
    return _greedy(table).select("doc_id")


def _greedy(table):
    size = F.col("n_chars")
    keyed = table("documents").select(
        "doc_id", text.text_key(F.col("text")).alias("text_key"),
        F.when(size % 10 != 0, F.concat_ws("|", "lang", size.cast("string"))).alias("event_key"),
        F.concat_ws("|", "source", F.floor(size / 7).cast("string")).alias("url_key"),
    )
    return dedupe.greedy_keep(keyed, "doc_id", ["text_key", "event_key", "url_key"])


@query("greedy_chain", """
WITH RECURSIVE k AS (
  SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) AS n, 'c' || o_custkey AS a,
    CASE WHEN o_orderkey % 3 = 0 THEN 's' || o_orderstatus END AS b FROM orders WHERE o_orderkey IS NOT NULL),
p AS (SELECT n, id, list_filter([a, b], lambda x: x IS NOT NULL) AS keys FROM k),
walk(n, id, kept, held) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), false, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT p.n, p.id, NOT list_has_any(w.held, p.keys), CASE WHEN list_has_any(w.held, p.keys) THEN w.held ELSE list_concat(w.held, p.keys) END
  FROM walk w JOIN p ON p.n = w.n + 1)
SELECT id AS o_orderkey FROM walk WHERE kept
""")
def greedy_chain(table, spark):
    """Orders by customer, and every third also by its status: three keys hold a third of all rows."""
    key = F.col("o_orderkey")
    keyed = table("orders").select(
        key, F.concat(F.lit("c"), "o_custkey").alias("a"), F.when(key % 3 == 0, F.concat(F.lit("s"), "o_orderstatus")).alias("b"))
    return dedupe.greedy_keep(keyed, "o_orderkey", ["a", "b"])


@query("anti_existing", f"""
WITH d AS (SELECT doc_id, source, {TEXT_KEY} AS text_key, 'https://x.org/' || source || '/' || (doc_id % 400) AS url_key,
             CASE WHEN doc_id % 3 <> 0 THEN lang || '|' || (n_chars % 500) END AS event_key FROM documents),
held AS (SELECT d.* FROM d JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 0)
SELECT doc_id, source FROM d
WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.text_key = d.text_key) AND NOT EXISTS (SELECT 1 FROM held h WHERE h.url_key = d.url_key)
  AND NOT EXISTS (SELECT 1 FROM held h WHERE h.event_key = d.event_key)
""")
def anti_existing(table, spark):
    """Documents that share none of the three stored keys with the rows already held."""
    doc = F.col("doc_id")
    keyed = table("documents").select(
        "doc_id", "source", text.text_key(F.col("text")).alias("text_key"),
        F.concat(F.lit("https://x.org/"), "source", F.lit("/"), doc % 400).alias("url_key"),
        F.when(doc % 3 != 0, F.concat("lang", F.lit("|"), F.col("n_chars") % 500)).alias("event_key"))
    held = cut_lineage(keyed.join(table("labels").where("quality = 0"), "doc_id", "left_semi"))
    for key in ("text_key", "url_key", "event_key"):
        keyed = dedupe.drop_held(keyed, held, key)
    return keyed.select("doc_id", "source")


@query("first_match_join", """
WITH hosts AS (SELECT lower(regexp_extract(url, '://(?:www\\.|m\\.|blog\\.)?([^/]*)', 1)) AS host, min(page_id) AS seq FROM pages GROUP BY 1),
items AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN lower(regexp_extract(url, '://[a-z]+\\.([a-z]+)\\.', 1)) ELSE lower(url) END AS asked FROM pages)
SELECT i.page_id, min(h.seq) AS matched_page FROM items i
LEFT JOIN hosts h ON i.asked <> '' AND (contains(i.asked, h.host) OR contains(h.host, i.asked)) GROUP BY 1
""")
def first_match_join(table, spark):
    return _first_match(table)


def _first_match(table):
    pages = table("pages")
    hosts = pages.groupBy(F.lower(F.regexp_extract("url", r"://(?:www\.|m\.|blog\.)?([^/]*)", 1)).alias("host")).agg(
        F.min("page_id").alias("seq"))
    asked = F.when(F.col("page_id") % 5 == 0, F.lower(F.regexp_extract("url", r"://[a-z]+\.([a-z]+)\.", 1))).otherwise(F.lower("url"))
    items = pages.select("page_id", F.nullif(asked, F.lit("")).alias("asked"))
    out = match.with_first_overlap(items, "asked", hosts, F.col("host"), "seq", "matched_page")
    return out.select("page_id", "matched_page")


@query("keyword_matrix", """
SELECT w AS word, (SELECT count(*) FROM pages WHERE contains(lower(html), w)) AS n_rows
FROM (SELECT unnest(['tion', 'login', 'article', 'heit', 'checkpoint', 'eaux']) AS w)
""")
def keyword_matrix(table, spark):
    return diagnostics.keyword_matrix(table("pages"), F.col("html"), ["tion", "login", "article", "heit", "checkpoint", "eaux"])


@query("page_diagnostics", """
WITH p AS (SELECT page_id, html, regexp_replace(regexp_replace(html,
  '<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'g') AS visible FROM pages)
SELECT page_id, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') AS title,
  len(regexp_extract_all(html, '(?i)<img\\b')) AS image_tags, len(regexp_extract_all(html, '(?i)<p\\b')) AS paragraphs,
  contains(lower(visible), 'login') AS login_hit, contains(lower(visible), 'tion') AS word_hit,
  md5(substr(trim(regexp_replace(visible, '\\s+', ' ', 'g')), 1, 1000)) AS snippet_md5, length(visible) AS visible_chars FROM p
""")
def page_diagnostics(table, spark):
    out = diagnostics.page_report(spread(table("pages")).select("page_id", "html", F.col("html").alias("h")), keywords=["tion"])
    return out.select(
        "page_id", "title", F.col("image_tags").cast("bigint").alias("image_tags"),
        F.regexp_count("h", F.lit(r"(?i)<p\b")).cast("bigint").alias("paragraphs"),
        F.col("login_hits")["login"].alias("login_hit"), F.col("keyword_hits")["tion"].alias("word_hit"),
        F.md5("snippet").alias("snippet_md5"), F.col("visible_chars").cast("bigint").alias("visible_chars"),
    )


@query("extract_once", """
SELECT d.doc_id, length(x.t) AS extracted_chars FROM documents d
JOIN (SELECT DISTINCT text AS k, lower(strip_accents(text)) AS t FROM documents) x ON x.k = d.text
""")
def extract_once(table, spark):
    docs = spread(table("documents"))
    out = dedupe.once_per_value(
        docs.select("doc_id", "text"), "text",
        lambda distinct: distinct.select("text", F.lower(text.normalize_unicode(F.col("text"))).alias("extracted")), "extracted")
    return out.select("doc_id", F.length("extracted").cast("bigint").alias("extracted_chars"))
