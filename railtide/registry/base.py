"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NOW = "2024-02-01 00:00:00"


def query(name: str, sql: str | None = None):
    """Register a function of (table loader, session) under ``name``."""

    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def pick(index: Column, *options: Column) -> Column:
    """The option at a place; only that one is evaluated."""
    out = F.when(index == 0, options[0])
    for place, option in enumerate(options[1:], start=1):
        out = out.when(index == place, option)
    return out


def one_of(words, text: str) -> str:
    """SQL for: any of the words occurs in ``text``."""
    quoted = ("'" + w.replace("'", "''") + "'" for w in words)
    return "(" + " OR ".join(f"contains({text}, {w})" for w in quoted) + ")"


def seeded(text: Column, seeds, key: str = "doc_id") -> Column:
    """``text`` with words of lists at its end: of (step, rest, words) if the key leaves that rest, upper-cased for odd keys.

    Which word it is depends on the key too, so that every word of every list is used.
    """
    key = F.col(key)
    out = F.coalesce(text, F.lit(""))
    for step, rest, words in seeds:
        word = F.element_at(F.array(*map(F.lit, words)), (F.floor(key / step) % len(words) + 1).cast("int"))
        out = F.concat(out, F.when(key % step == rest, F.concat(F.lit(" "), F.when(key % 2 == 1, F.upper(word)).otherwise(word))).otherwise(""))
    return out


def seeded_sql(text: str, seeds, key: str = "doc_id") -> str:
    """The same in SQL."""
    out = f"coalesce({text}, '')"
    for step, rest, words in seeds:
        quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
        word = f"([{quoted}])[CAST(floor({key} / {step}.0) AS BIGINT) % {len(words)} + 1]"
        out += f" || CASE WHEN {key} % {step} = {rest} THEN ' ' || CASE WHEN {key} % 2 = 1 THEN upper({word}) ELSE {word} END ELSE '' END"
    return out
