"""Limits per group: tiered top-k, extraction budgets, batch filters and cost estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtide import vocab


def sweep_table(spark: SparkSession, sweeps=vocab.SWEEPS) -> DataFrame:
    return spark.createDataFrame(sweeps, "mode string, tier string, post_limit int, max_age_days double")


def sweep_limits(mode: str, sweeps=vocab.SWEEPS) -> tuple[dict[str, int], float]:
    """(limit per tier, look-back in days); an unknown mode means the default one."""
    rows = [s for s in sweeps if s[0] == mode.lower()] or [s for s in sweeps if s[0] == vocab.DEFAULT_MODE]
    return {tier: limit for _, tier, limit, _ in rows}, rows[0][3]


def tier_limit(tier: Column, limits: dict[str, int]) -> Column:
    """Limit of a tier; unknown tiers get the quiet one."""
    default = F.lit(limits.get(vocab.DEFAULT_TIER, 1))
    pairs = [F.lit(p) for item in limits.items() for p in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(tier, F.lit(vocab.DEFAULT_TIER))), default)


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int,
            rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group.  Each map task already drops what cannot be among them."""
    name = rank or "_rn"
    window = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_n_by_tier(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], tier: Column,
                    limits: dict[str, int], rank: str = "rank") -> DataFrame:
    """Top rows of each group where the number kept depends on the group's tier.

    The largest limit is a literal bound, so the rank limit applies before the shuffle; the tier's
    own limit then trims the few rows that are left.
    """
    best = first_n(df, group, order, max(limits.values()), rank)
    return best.where(F.col(rank) <= tier_limit(tier, limits))


def cost_estimate(pages: DataFrame, limits: dict[str, int], tier: str = "tier",
                  unit_cost: float = vocab.COST_PER_POST) -> DataFrame:
    posts = F.sum(tier_limit(F.col(tier), limits)).cast("bigint")
    return pages.agg(posts.alias("expected_posts"), (posts * F.lit(unit_cost)).alias("estimated_cost"))


def cost_table(pages: DataFrame, modes: Sequence[str], tier: str = "tier",
               unit_cost: float = vocab.COST_PER_POST) -> DataFrame:
    """Expected posts and cost of each mode, from one pass over the pages."""
    sums = [F.sum(tier_limit(F.col(tier), sweep_limits(m)[0])).cast("bigint").alias(f"m{i}") for i, m in enumerate(modes)]
    rows = F.array(*[
        F.struct(F.lit(m).alias("mode"), F.col(f"m{i}").alias("expected_posts"), (F.col(f"m{i}") * F.lit(unit_cost)).alias("estimated_cost"))
        for i, m in enumerate(modes)
    ])
    return pages.agg(*sums).select(F.inline(rows))


def pages_by_limit(pages: DataFrame, limits: dict[str, int], tier: str = "tier", url: str = "url") -> DataFrame:
    """How many pages, and from which to which, share a limit (one request batch per limit)."""
    return (
        pages.withColumn("post_limit", tier_limit(F.col(tier), limits))
        .groupBy("post_limit")
        .agg(F.count(url).alias("pages"), F.min(url).alias("first_url"), F.max(url).alias("last_url"))
    )


def in_batches(pages: DataFrame, wanted: str, batch: str = "batch") -> DataFrame:
    """Pages of a comma list of batches, any case; ``all`` and lists without a match mean all pages."""
    names = [n.strip().upper() for n in wanted.split(",") if n.strip()]
    if wanted.strip().lower() == "all":
        return pages
    chosen = pages.where(F.upper(F.coalesce(F.col(batch), F.lit(""))).isin(*names)) if names else pages.where("false")
    return pages if chosen.isEmpty() else chosen


def budget(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
           n: int = vocab.EXTRACTIONS_PER_PAGE) -> DataFrame:
    """Flag the first ``n`` extraction attempts of each group; every row stays.

    Only the chosen rows pass through the window; the flag comes back by an equi-join on the order
    columns, which must identify a row inside its group.
    """
    keys = [*group, *[o if isinstance(o, str) else None for o in order]]
    if None in keys:
        raise ValueError("budget needs plain column names to order by")
    chosen = first_n(df.select(*keys), group, order, n).withColumn("within_budget", F.lit(True))
    return df.join(chosen, keys, "left").withColumn("within_budget", F.coalesce("within_budget", F.lit(False)))
