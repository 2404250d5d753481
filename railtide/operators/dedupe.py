"""Keep-first dedupe on one key, and order-dependent dedupe on several keys at once."""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.session import cut_lineage

log = logging.getLogger(__name__)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key.  The rank limit of one is applied before the shuffle as well."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_first_or_blank(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """First row of each key; rows without a key all stay, each in a group of its own."""
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return keep_first(df.withColumn("_own", own), [key, "_own"], order).drop("_own")


def drop_held(df: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows whose key the state does not hold; rows without a key stay."""
    known = held.select(F.col(key).alias("_known")).where("_known is not null").distinct()
    return df.join(known, df[key] == known["_known"], "left_anti")


def _settle_chains(single: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows of ``single`` (ord, before) that are kept, where each is kept exactly if ``before`` is not.

    Pointer doubling: after k steps a row knows the row 2 ** k places before it and whether their
    fates differ, so a chain of n rows takes log2(n) steps.  Chains that end at a winner settle;
    those that end at a row whose fate is still open settle nothing yet.
    """
    links = cut_lineage(single.select("ord", F.col("before").alias("to"), F.lit(True).alias("differs")))
    ahead = None
    while True:
        next_ = links.select(F.col("ord").alias("to"), F.col("to").alias("_far"), F.col("differs").alias("_flips"))
        links = cut_lineage(
            links.join(next_, "to", "left").select(
                "ord", F.coalesce("_far", "to").alias("to"),
                F.when(F.col("_far").isNull(), F.col("differs")).otherwise(F.col("differs") != F.col("_flips")).alias("differs"),
            )
        )
        now = links.agg(F.sum(F.col("to").cast("decimal(38,0)"))).first()[0]
        if now == ahead:
            break
        ahead = now
    return links.where("not differs").join(winners.select(F.col("ord").alias("to")), "to", "left_semi").select("ord")


def greedy_keep(df: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    """Ids (``order``) of the rows a sequential pass would keep.

    In order, a row is kept unless an earlier *kept* row holds one of its keys; dropped rows hold
    nothing, and NULL keys never count.  ``order`` is a unique BIGINT.

    Each round decides every row that is the first undecided holder of all its keys, every row
    that hangs on these by a chain of single earlier holders, and all rows that share a key with a
    row so kept.  Only the first two holders of a key are looked at, so a key held by most rows
    costs no more than any other, and the number of rounds is that of nested forks, not of rows;
    it is logged.
    """
    rows = df.select(F.col(order).cast("bigint").alias("ord"), *[F.col(k).cast("string").alias(k) for k in keys])
    has_key = functools.reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys])
    free = rows.where(~has_key).select("ord")

    # keys are compared by digest; rows with the same keys throughout merge before the shuffle
    digests = rows.where(has_key).select("ord", *[F.unhex(F.md5(F.col(k).cast("binary"))).alias(k) for k in keys])
    same = digests.groupBy(*keys).agg(F.min("ord").alias("ord"))
    slots = F.array_compact(F.array(*[
        F.when(F.col(k).isNotNull(), F.struct(F.lit(i).alias("slot"), F.col(k).alias("key")))
        for i, k in enumerate(keys)
    ]))
    edges = cut_lineage(
        same.select("ord", slots.alias("keys")).select("ord", F.size("keys").alias("n"), F.inline("keys")))

    kept_parts = []
    while not edges.isEmpty():
        holders = Window.partitionBy("slot", "key").orderBy("ord")
        two = (
            edges.withColumn("rank", F.row_number().over(holders)).where("rank <= 2")
            .withColumn("before", F.lag("ord").over(holders))
        )
        seen = cut_lineage(
            two.groupBy("ord", "n").agg(F.count("*").alias("known"), F.min("before").alias("low"), F.max("before").alias("high"))
            .where("known = n and (low is null or low = high)")
        )
        winners = seen.where("low is null").select("ord")
        single = seen.where("low is not null").select("ord", F.col("low").alias("before"))
        kept = winners if single.isEmpty() else cut_lineage(winners.unionByName(_settle_chains(single, winners)))
        kept_parts.append(kept)
        taken = edges.join(kept, "ord", "left_semi").select("slot", "key").distinct()
        decided = edges.join(taken, ["slot", "key"], "left_semi").select("ord").distinct()
        edges = cut_lineage(edges.join(decided, "ord", "left_anti"))
    log.info("greedy dedupe took %d rounds", len(kept_parts))
    kept = functools.reduce(DataFrame.unionByName, kept_parts, free)
    return kept.select(F.col("ord").alias(order))


def greedy_dedupe(df: DataFrame, order: str, keys: Sequence[str],
                  held: Sequence[tuple[str, DataFrame]] = ()) -> DataFrame:
    """Rows of ``df`` that survive the state's keys and the sequential pass over ``keys``."""
    fresh = df
    for key, state in held:
        fresh = drop_held(fresh, state, key)
    kept = greedy_keep(fresh, order, keys)
    return fresh.join(kept, order, "left_semi")


def once_per_value(df: DataFrame, value: str, extract, extracted: str) -> DataFrame:
    """Run ``extract`` (DataFrame of distinct values -> value, result) once per value, then join back.

    Values may be whole texts, so they meet their results on a digest.
    """
    digest = F.sha2(F.col(value).cast("string"), 256)
    distinct = df.where(F.col(value).isNotNull()).groupBy(digest.alias("_digest")).agg(F.any_value(value).alias(value))
    results = extract(distinct.select(value))
    found = results.select(digest.alias("_digest"), F.col(extracted))
    return df.withColumn("_digest", digest).join(found, "_digest", "left").drop("_digest")
