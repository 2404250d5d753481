"""Sequential ids over a total order, and the next free id."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.operators.joins import unique_left_join
from railtide.session import cut_lineage

ROW_BITS = (1 << 33) - 1
PART_SHIFT = 33


def number_rows(df: DataFrame, order: Sequence[Column | str], out: str = "seq",
                partitions: int | None = None) -> DataFrame:
    """Number all rows 1..n by a unique order, without a single-task window.

    Range partitions are sorted and written once to the checkpoint folder; a row's number is its
    place in its partition plus the row counts of the partitions before it.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(count, *order).sortWithinPartitions(*order))
    sizes = {r["p"]: r["n"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return ranged.withColumn(out, F.lit(0).cast("bigint"))
    # one entry per partition, so the array is as long as the plan is wide
    starts = list(itertools.accumulate((sizes.get(p, 0) for p in range(max(sizes) + 1)), initial=0))
    place = F.monotonically_increasing_id()
    tagged = ranged.withColumn("_place", place)
    part = F.shiftright("_place", PART_SHIFT).cast("int")
    offset = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), part + 1)
    return tagged.withColumn(out, offset + F.col("_place").bitwiseAND(F.lit(ROW_BITS)) + 1).drop("_place")


def number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], out: str = "seq",
                  partitions: int | None = None) -> DataFrame:
    """Number rows 1..n inside each group, also when one group holds most rows.

    Numbers everything by (group, order) and subtracts the number before the group's first row.
    """
    numbered = number_rows(df, [*group, *order], "_all", partitions)
    first = numbered.groupBy(*group).agg(F.min("_all").alias("_first"))
    met = unique_left_join(numbered, first, group)
    return met.withColumn(out, F.col("_all") - F.col("_first") + 1).select(*df.columns, out)


def padded_id(prefix: Column, number: Column, mark: str = "-") -> Column:
    """``CAP-0001``; numbers past 9999 get wider instead of being cut."""
    return F.concat(prefix, F.lit(mark), F.format_string("%04d", number))


def next_number(df: DataFrame, id_column: str, base: str) -> DataFrame:
    """One row: the number after the highest ``<base>_<digits>``; other families do not count."""
    digits = F.regexp_extract(F.lower(F.col(id_column)), rf"^{base.lower()}_(\d+)$", 1)
    highest = F.max(F.nullif(digits, F.lit("")).try_cast("bigint"))
    return df.agg((F.coalesce(highest, F.lit(0)) + 1).alias("next_number")).withColumn(
        "next_id", padded_id(F.lit(base), F.col("next_number"), "_")
    )


def next_numbers(df: DataFrame, id_column: str) -> DataFrame:
    """Per id family: the highest number in use."""
    pattern = r"^(.*)_(\d+)$"
    return (
        df.select(
            F.regexp_extract(F.col(id_column), pattern, 1).alias("base"),
            F.nullif(F.regexp_extract(F.col(id_column), pattern, 2), F.lit("")).try_cast("bigint").alias("n"),
        )
        .where(F.col("n").isNotNull())
        .groupBy("base")
        .agg(F.max("n").alias("last_number"))
    )
