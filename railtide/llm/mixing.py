"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.session import cut_lineage

WEIGHTS = (3, 1, 2)
# words of the mix for each word of the corpus
SHARE = 1.5
MOST_COPIES = 2
# ranks are first added up in this many classes, a power of two
CLASSES = 1 << 14
# per-source tables may be broadcast up to this many rows
BROADCAST_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: str, seed: str = "mix") -> Column:
    """A number in (0, 1) that depends on the key alone, so reruns agree; NULL keys share one."""
    digits = F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|" + seed)).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (absent, source, source_size) with ``target`` words, their excess reshared.

    Sources are few beside documents.  Those whose cap is smallest for their weight reach it first;
    the first one that stays below its cap fixes the rate per weight for itself and all after it.
    """
    by_name = Window.orderBy("absent", "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("bigint")
    weighed = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "absent", "source")
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    rated = weighed.select(
        "absent", "source", "source_size", "weight", "cap",
        ((share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         / F.sum("weight").over(after)).alias("rate"),
        F.row_number().over(by_ratio).alias("place"),
    )
    below = F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.struct("place", "rate"))
    rate = F.min(below).over(everything)["rate"]
    return rated.select(
        "absent", "source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(rate * F.col("weight"), F.col("cap").cast("double"))).alias("target"),
    )


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """q / (1 + q), where q is the random odds over the inclusion odds; small ranks enter first."""
    random, odds = u * (1 - inclusion), inclusion * (1 - u)
    return random / (random + odds)


def _plan(rows: DataFrame, weights, share, most) -> DataFrame:
    """Per source: target, certain whole copies, words still to draw and the inclusion probability."""
    sources = cut_lineage(rows.groupBy("absent", "source").agg(F.sum("size").alias("source_size")))
    targets = source_targets(sources, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return cut_lineage(
        targets.withColumn("whole", F.floor(rate).cast("int")).withColumn("inclusion", rate - F.col("whole"))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    )


def _small(table: DataFrame) -> DataFrame:
    """Broadcast a table of sources once it has been counted as small."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _source(column: str = "source") -> list[Column]:
    return [F.col(column).isNull().alias("absent"), F.coalesce(F.col(column), F.lit("")).alias("source")]


def draw(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
         weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES):
    """(rows, cuts): ``rows`` (key, absent, source, size, u) of all documents, and per source its cut.

    Within a source the sample is the prefix, in Pareto order, whose words come closest to the
    words wanted.  Words are added up per class of ranks first; only the class in which a source
    reaches its words is put in order row by row, so no source meets in one task.
    """
    rows = cut_lineage(docs.select(
        F.coalesce(F.col(key), F.lit(-(1 << 63))).alias("key"), F.col(key).alias("given"), *_source(source),
        word_count(text).alias("size"), uniform(key).alias("u"),
    ))
    plan = _plan(rows, weights, share, most)
    ranked = rows.join(_small(plan.where("inclusion > 0")), ["absent", "source"]).select(
        "absent", "source", "key", "size", "wanted", pareto_rank(F.col("u"), F.col("inclusion")).alias("rank")
    ).withColumn("class", F.floor(F.col("rank") * CLASSES))
    upto = Window.partitionBy("absent", "source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = ranked.groupBy("absent", "source", "class").agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
    reach = (
        classes.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
        .where("before < wanted AND before + words >= wanted").select("absent", "source", "class", "before")
    )
    reach = cut_lineage(reach)
    within = Window.partitionBy("absent", "source").orderBy("rank", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        ranked.join(_small(reach), ["absent", "source", "class"])
        .withColumn("taken", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .where("2 * taken + size <= 2 * wanted")
        .groupBy("absent", "source").agg(F.max(F.struct("rank", "key", "size")).alias("cut"))
    )
    # without a row of its own in the class, the cut lies just before the class
    edge = F.struct((F.col("class") / CLASSES).cast("double").alias("rank"), F.lit(-(1 << 63)).alias("key"), F.lit(-1).cast("bigint").alias("size"))
    cuts = cut_lineage(
        plan.join(reach, ["absent", "source"], "left").join(last, ["absent", "source"], "left")
        .select("absent", "source", "source_size", "target", "whole", "inclusion",
                F.coalesce("cut", F.when(F.col("class").isNotNull(), edge)).alias("cut"))
    )
    return rows, cuts


def copies() -> Column:
    """Copies of a row that has been joined to its source's cut."""
    rank = pareto_rank(F.col("u"), F.col("inclusion"))
    # a source that never reaches its words, by rounding, takes every row
    drawn = F.when(F.col("inclusion") > 0, F.col("cut").isNull() | (F.struct(rank.alias("rank"), "key", "size") <= F.col("cut")))
    return F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("int")


def op7(docs: DataFrame) -> DataFrame:
    """Result of the registered query."""
    rows, cuts = draw(docs)
    return rows.join(_small(cuts), ["absent", "source"]).select(
        F.col("given").alias("doc_id"), "size", "source_size", "target", (F.col("size") * copies()).alias("taken")
    )


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (not at all, once or up to ``most`` times).

    The size of a document is its words; NULL sources are a source of their own, after all others.
    Rows that repeat key, source and size are drawn together.  A source without words has target 0
    and gives nothing.  Texts do not move: each row is compared with its source's cut where it is.
    Columns may have any names; an empty table stays empty.
    """
    _, cuts = draw(docs, text, key, source, **options)
    held = docs.select(
        F.struct("*").alias("row"), *_source(source), uniform(key).alias("u"),
        F.coalesce(F.col(key), F.lit(-(1 << 63))).alias("key"), word_count(text).alias("size"),
    )
    met = held.join(_small(cuts), ["absent", "source"])
    return met.select("row", F.explode(F.array_repeat(F.lit(1), copies()))).select("row.*")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|mix'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT source, source_size, weight, 2 * source_size AS cap,
         (1.5 * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate,
         row_number() OVER o AS place
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST)
), t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce((SELECT arg_min(rate, place) FROM r WHERE rate * weight <= cap) * weight, cap::DOUBLE)) AS target
  FROM r
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t
), q AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, floor(p.rate) AS whole, p.rate - floor(p.rate) AS f,
         p.target - floor(p.rate) * p.source_size AS wanted,
         coalesce(sum(d.size) OVER (PARTITION BY d.source
           ORDER BY d.u * (1 - (p.rate - floor(p.rate))) / (d.u * (1 - (p.rate - floor(p.rate))) + (p.rate - floor(p.rate)) * (1 - d.u)), d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN f > 0 AND 2 * before + size <= 2 * wanted THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q
"""
