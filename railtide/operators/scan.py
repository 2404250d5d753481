"""Ordered carry-forward that never puts a whole group into one task.

A plain window over a hot group sorts all of it in one task.  Here rows are range partitioned and
cut into chunks of counted rows: windows run inside a chunk, one summary row per chunk carries the
last value on inside a run of chunks, one row per run carries it across, and all meet on unique keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtide.session import cut_lineage

# rows of a chunk, and chunks of a run
CHUNK_ROWS = 1 << 16
RUN_CHUNKS = 1 << 16


def chunked(df: DataFrame, group: Sequence[str], order: str, out: str = "_chunk", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with a chunk number that grows with (group, order); no chunk has more than ``chunk_rows`` rows.

    Rows are range partitioned, sorted and written once to the checkpoint folder, then counted
    where they are: how far apart order values lie does not matter.
    """
    ranged = cut_lineage(df.repartitionByRange(*group, order).sortWithinPartitions(*group, order))
    # a partition's rows count from a multiple of 2 ** 33
    return ranged.withColumn(out, F.floor(F.monotonically_increasing_id() / F.lit(chunk_rows)))


def carry_forward(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    values: dict[str, Column],
    chunk: Column | None = None,
    include_current: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add for each name the last non-NULL value at or before the row (before it, if not inclusive).

    ``order`` must be unique inside a group and groups must not be NULL.  ``chunk`` must grow with
    ``order``; the default cuts chunks of ``chunk_rows`` counted rows.
    """
    end = Window.currentRow if include_current else -1
    held = {name: f"_held_{name}" for name in values}
    work = df.withColumns({held[n]: v for n, v in values.items()})
    if chunk is None:
        work = chunked(work, group, order, "_part", chunk_rows)
        chunk = F.col("_part")
    work = work.withColumn("_chunk", chunk)
    keys = [*group, "_chunk"]

    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    local = work.withColumns({n: F.last(h, ignorenulls=True).over(inside) for n, h in held.items()})
    ends = work.groupBy(*keys).agg(
        *[F.max_by(h, F.when(F.col(h).isNotNull(), F.col(order))).alias(f"_end_{n}") for n, h in held.items()]
    )
    carried = _carry_ends(ends, group, list(values))
    met = local.join(carried, [F.col(k) == F.col(f"_c{k}") for k in keys], "left")
    return met.withColumns(
        {n: F.coalesce(F.col(n), F.col(f"_in_{n}")) for n in values}
    ).select(*[c for c in df.columns if c not in values], *values)


def _carry_ends(ends: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per (group, chunk) what comes in from the chunks before: inside a run of chunks, then across runs."""
    runs = ends.withColumn("_run", F.floor(F.col("_chunk") / RUN_CHUNKS))
    before = (Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*group, "_run").orderBy("_chunk").rowsBetween(*before)
    tops = runs.groupBy(*group, "_run").agg(
        *[F.max_by(f"_end_{n}", F.when(F.col(f"_end_{n}").isNotNull(), F.col("_chunk"))).alias(f"_top_{n}") for n in names]
    )
    # a run ends at the latest where a range partition ends, so there are few
    across = (Window.partitionBy(*group).orderBy("_run") if group else Window.orderBy("_run")).rowsBetween(*before)
    above = tops.select(
        *[F.col(g).alias(f"_t{g}") for g in group], F.col("_run").alias("_t_run"),
        *[F.last(f"_top_{n}", ignorenulls=True).over(across).alias(f"_above_{n}") for n in names],
    )
    local = runs.withColumns({f"_near_{n}": F.last(f"_end_{n}", ignorenulls=True).over(inner) for n in names})
    met = local.join(above, [F.col(k) == F.col(f"_t{k}") for k in [*group, "_run"]], "left")
    return met.select(
        *[F.col(k).alias(f"_c{k}") for k in [*group, "_chunk"]],
        *[F.coalesce(f"_near_{n}", f"_above_{n}").alias(f"_in_{n}") for n in names],
    )
