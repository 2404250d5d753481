"""Row rules, quarantine, and all-or-nothing acceptance of files and years."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.operators.joins import unique_left_join


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks.  Like a CHECK, a rule that is NULL holds."""
    return F.array_compact(F.array(*[F.when(~holds, F.lit(name)) for name, holds in rules.items()]))


def with_rejects(df: DataFrame, rules: Mapping[str, Column], out: str = "rejects") -> DataFrame:
    return df.withColumn(out, broken_rules(rules))


def accepted(df: DataFrame, rejects: str = "rejects") -> DataFrame:
    return df.where(F.size(rejects) == 0).drop(rejects)


def quarantined(df: DataFrame, rejects: str = "rejects") -> DataFrame:
    return df.where(F.size(rejects) > 0)


def group_status(df: DataFrame, group: Sequence[str], rejects: str = "rejects") -> DataFrame:
    """Rows, bad rows and verdict per group (a file or a year)."""
    return df.groupBy(*group).agg(
        F.count("*").alias("rows"),
        F.count_if(F.size(rejects) > 0).alias("bad_rows"),
    ).withColumn("accepted", F.col("bad_rows") == 0)


def whole_groups(df: DataFrame, group: Sequence[str], rejects: str = "rejects") -> DataFrame:
    """Rows of the groups that hold no bad row at all."""
    status = group_status(df, group, rejects).select(*group, "accepted")
    return unique_left_join(df, status, group).where("accepted").drop("accepted", rejects)
