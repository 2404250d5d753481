"""SpotSigs document fingerprints, in DataFrame operations only."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.llm.words import bound, words_column
from railtide.session import cut_lineage

# common words of English, German, French and Spanish that anchor signatures (fixed values)
ANCHORS = (
    "a an and are as at be by for from has have in is it not of on or that the this to was were what which with you "
    "als auf auch aus das dem den der des die ein eine er für im ist mit nicht sich sie um und von war wie zu "
    "au aux ce dans du elle en est et il la le les ne pas par pour que qui se son sur un une "
    "como con de del el es las lo los más no para por se su sus una y"
).split()
CHAIN = 2
THRESHOLD = 0.8
# rows of a range of documents that are put in order together
RANGE_ROWS = 1_000
MOST_RANGES = 1 << 14


def signatures(words: Column) -> Column:
    """Sorted set of signatures of an array of words: each anchor with the next CHAIN content words.

    Walks over the content words: all anchors since the content word before belong to the chain
    that starts here.  A text with words but no chain has one signature, all of its words.
    """
    def chains(every: Column, own: Column) -> Column:
        def at(c: Column, i: Column) -> Column:
            before = F.coalesce(F.get(own, F.when(i > 0, i - 1))["at"], F.lit(-1))
            chain = F.concat_ws(" ", *[F.get(own, i + n)["word"] for n in range(CHAIN)])
            anchors = F.slice(every, before + 2, c["at"] - before - 1)
            return F.when(
                (c["at"] - before > 1) & (i + CHAIN <= F.size(own)), F.transform(anchors, lambda a: F.concat_ws(" ", a, chain))
            ).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.flatten(F.transform(own, at)))

    def signed(every: Column) -> Column:
        content = F.filter(F.transform(every, lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda c: ~c["word"].isin(*ANCHORS))
        found = bound(content, lambda own: chains(every, own))
        whole = F.when(F.size(every) > 0, F.array(F.concat_ws(" ", every))).otherwise(F.array().cast("array<string>"))
        return bound(found, lambda f: F.when(F.size(f) > 0, F.array_sort(f)).otherwise(whole))

    return bound(words, signed)


def print_of(signed: Column) -> Column:
    """Fingerprint as text: the digest of the sorted signatures."""
    return F.sha2(F.array_join(signed, "\n").cast("binary"), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty sets are alike."""
    def share(both: Column) -> Column:
        every = F.size(a) + F.size(b) - both
        return F.when(every > 0, both / every).otherwise(F.lit(1.0))

    return bound(F.size(F.array_intersect(a, b)), share)


def length_class(n: Column, threshold: float = THRESHOLD) -> Column:
    """Partition of a set length: sets in classes that do not touch cannot be alike by ``threshold``."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9)).cast("int")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, likeness): pairs of different fingerprints, each under its smallest key, that are alike.

    Texts with one fingerprint are one set, so copies never pair up.  Sets are dealt by length
    class and meet on a signature among their rarest: two sets alike by ``threshold`` share one of
    the first n - ceil(threshold * n) + 1 in that order.  Lengths prune what meets, and the Jaccard
    similarity of whole sets decides.  Sets without signatures are not compared.
    """
    signed = docs.select(F.col(key).alias("id"), signatures(words_column(F.col(text))).alias("signed"))
    sets = cut_lineage(
        signed.where(F.size("signed") > 0).groupBy("signed").agg(F.min("id").alias("id")).where("id is not null")
        .select("id", "signed", F.size("signed").alias("n"))
    )
    listed = sets.select("id", "n", F.explode("signed").alias("sig"))
    often = listed.groupBy("sig").agg(F.count("*").alias("often"))
    rarest = Window.partitionBy("id").orderBy("often", "sig")
    prefix = (
        listed.join(often, "sig").withColumn("place", F.row_number().over(rarest))
        .where(F.col("place") <= F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1)
        .select("id", "n", "sig", length_class(F.col("n"), threshold).alias("class"))
    )
    prefix = cut_lineage(prefix)
    # the longer set looks in its own class and in the one below
    longer = prefix.select(F.col("id").alias("a"), F.col("n").alias("an"), "sig", F.explode(F.array("class", F.col("class") - 1)).alias("class"))
    shorter = prefix.select(F.col("id").alias("b"), F.col("n").alias("bn"), "sig", "class")
    met = longer.join(shorter, ["sig", "class"]).where(
        ((F.col("an") > F.col("bn")) | ((F.col("an") == F.col("bn")) & (F.col("a") < F.col("b")))) & (F.col("bn") >= threshold * F.col("an") - 1e-9)
    ).select("a", "b").distinct()
    one = sets.select(F.col("id").alias("a"), F.col("signed").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("signed").alias("sb"))
    scored = met.join(one, "a").join(two, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
    return scored.where(F.col("likeness") >= threshold).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


def _neighbours(docs: DataFrame, key: str, text: str):
    """(rows, order): each row with the text of the row after it by descending key; the last has the first's.

    Rows are dealt to ranges of keys.  A range's first row is also dealt to the range before it, as
    the row that follows its last one, so texts are shuffled once and no range needs another.
    NULL keys come last; rows that repeat a key follow each other by the hash of their text.
    """
    order_key = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    stats = docs.agg(F.count("*").alias("n")).first()["n"]
    ranges = max(1, min(MOST_RANGES, stats // RANGE_ROWS))
    shares = [i / ranges for i in range(1, ranges + 1)]
    # each bound is the key of a row, the largest key among them; range 0 starts there
    bounds = docs.select(F.percentile_approx(order_key, shares, max(10_000, 10 * ranges))).first()[0]
    bounds = sorted(set(bounds or [0]), reverse=True)
    width = max(1, int(len(bounds) ** 0.5))
    # two levels, so that a row looks at about twice the root of the bounds; a constant of the plan
    levels = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    rows = F.from_json(F.lit(json.dumps(levels)), "array<array<bigint>>")
    heads = F.from_json(F.lit(json.dumps([r[0] for r in levels])), "array<bigint>")
    held = docs.select(
        F.col(key).alias("_given"), order_key.alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
        (F.size(F.filter(heads, lambda h: h >= order_key)) - 1).alias("_level"),
    ).withColumn("_row", F.get(rows, F.col("_level")))
    held = held.withColumn("_place", F.size(F.filter("_row", lambda b: b >= F.col("_key"))) - 1)
    number = (F.col("_level") * width + F.col("_place")).alias("_range")
    starts = F.get("_row", F.col("_place")) == F.col("_key")
    placed = held.select("_given", "_key", "_text", number, starts.alias("_starts"))
    before = F.pmod(F.col("_range") - 1, F.lit(len(bounds)))
    both = F.when(F.col("_starts"), F.array("_range", before)).otherwise(F.array("_range"))
    dealt = placed.select("_given", "_key", "_text", F.posexplode(both).alias("_guest", "_in"))
    order = Window.partitionBy("_in").orderBy("_guest", F.desc("_key"), F.xxhash64("_text"))
    return dealt.withColumn("_next", F.lead("_text").over(order)), order


def op1(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return edited_prints(docs)


def edited_prints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited forms, with likenesses.

    The edited text's last floor(n / 2) code points are the first as many (or all) of the next
    document.  NULL is the empty text; empty texts have the empty set, whose likeness to itself is
    1 and to any other 0.  A single document is its own next one.
    """
    met, order = _neighbours(docs, key, text)
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.col("_next"), F.lit(1), half))
    signed = (
        met.withColumn("_n", n).withColumn("_edited", edited)
        .select("_given", "_key", "_text", "_guest", "_in", "_n", F.sha2(F.col("_edited").cast("binary"), 256).alias("_sha"),
                signatures(words_column(F.col("_text"))).alias("_own"), signatures(words_column(F.col("_edited"))).alias("_changed"))
        .withColumn("_after", F.lead("_own").over(order))
    )
    return signed.where("_guest = 0").select(
        F.col("_given").alias(key), F.col("_n").cast("bigint").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
        print_of(F.col("_own")).alias("fingerprint"), print_of(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )


def _sql() -> str:
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS own, length(coalesce(text, '')) AS n FROM documents
), e AS (
  SELECT doc_id, own, n, coalesce(
    lead(own) OVER (ORDER BY doc_id DESC),
    first_value(own) OVER (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS after
  FROM d
), f AS MATERIALIZED (
  SELECT doc_id, own, n, substring(own, 1, n - n // 2) || substring(after, 1, n // 2) AS changed,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id
  FROM e
), w AS (
  SELECT doc_id, kind, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words
  FROM (SELECT doc_id, 0 AS kind, own AS text FROM f UNION ALL SELECT doc_id, 1, changed FROM f)
), u AS (
  SELECT doc_id, kind, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), p AS MATERIALIZED (
  SELECT *, word IN ({anchors}) AS anchor,
         sum(CASE WHEN word IN ({anchors}) THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, kind ORDER BY i) AS j
  FROM u
), s AS (
  SELECT a.doc_id, a.kind, list_sort(list(DISTINCT a.word || ' ' || b.word || ' ' || c.word)) AS signed
  FROM p a JOIN p b ON b.doc_id = a.doc_id AND b.kind = a.kind AND b.j = a.j + 1 AND NOT b.anchor
  JOIN p c ON c.doc_id = a.doc_id AND c.kind = a.kind AND c.j = a.j + 2 AND NOT c.anchor
  WHERE a.anchor GROUP BY ALL
), g AS MATERIALIZED (
  SELECT w.doc_id, w.kind, CASE WHEN s.signed IS NOT NULL THEN s.signed WHEN len(w.words) > 0 THEN [array_to_string(w.words, ' ')] ELSE [] END AS signed
  FROM w LEFT JOIN s ON s.doc_id = w.doc_id AND s.kind = w.kind
), m AS (
  SELECT f.doc_id, f.n, f.changed, o.signed AS o, c.signed AS c, x.signed AS x
  FROM f JOIN g o ON o.doc_id = f.doc_id AND o.kind = 0 JOIN g c ON c.doc_id = f.doc_id AND c.kind = 1
  JOIN g x ON x.doc_id = f.next_id AND x.kind = 0
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(changed) AS edited_sha256,
       sha256(array_to_string(o, chr(10))) AS fingerprint, sha256(array_to_string(c, chr(10))) AS edited_fingerprint,
       CASE WHEN len(o) + len(c) = 0 THEN 1.0 ELSE len(list_intersect(o, c)) / (len(o) + len(c) - len(list_intersect(o, c)))::DOUBLE END AS near_edited,
       CASE WHEN len(o) + len(x) = 0 THEN 1.0 ELSE len(list_intersect(o, x)) / (len(o) + len(x) - len(list_intersect(o, x)))::DOUBLE END AS near_next
FROM m
"""


OP1_SQL = _sql()
