"""Ridership sheets to numbered period rows with daily totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.functions import labels
from railtide.operators import dedupe, ids, merge, reshape, sheets
from railtide.session import cut_lineage
from railtide.sinks import tables
from railtide.sources import files

ROW_KEYS = ["year", "file", "row_idx", "date", "time_period", "sort_month", "is_detail"]


@dataclass
class Ridership:
    """Long rows, the wide numbered rows of the accepted years, and the verdict per year."""

    long: DataFrame
    wide: DataFrame
    status: DataFrame


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(F.url_decode(path), "/"), -1), r"\.[^.]*$", "")


def long_rows(grid: DataFrame, count_existing_totals: bool = False, per_file_totals: bool = True) -> tuple[DataFrame, DataFrame]:
    """(long rows of all sheets with their daily totals, problems per file)."""
    named = grid.withColumns({
        "year": labels.file_year(_stem(F.col("file"))), "month": labels.file_month(_stem(F.col("file"))),
    }).where("year is not null and month is not null")
    heads = cut_lineage(sheets.blocks(named))
    monthly_files = heads.where("is_monthly").select("file").distinct()
    year, month = F.col("year"), F.col("month")
    of_file = named.select("file", "year", "month").distinct()

    daily_heads, parsed = heads, sheets.period_rows(named, heads, year).withColumn("is_monthly", F.lit(False))
    if not monthly_files.isEmpty():
        # a monthly summary replaces the other blocks of its file
        daily_heads = heads.join(monthly_files, "file", "left_anti")
        monthly = sheets.monthly_rows(named.join(monthly_files, "file", "left_semi"), heads, year, month)
        daily = sheets.period_rows(named, daily_heads, year).withColumn("is_monthly", F.lit(False))
        parsed = daily.unionByName(monthly.withColumn("is_monthly", F.lit(True)))
    stem = _stem(F.col("file"))
    parsed = cut_lineage(parsed.withColumns({"year": labels.file_year(stem), "month": labels.file_month(stem)}))
    problems = sheets.sheet_problems(daily_heads, parsed)
    empty = of_file.join(parsed.select("file").distinct(), "file", "left_anti")
    problems = problems.unionByName(empty.select("file", F.lit("no_rows").alias("problem")))

    keys = ["file", "year", "month", "column_name"] if per_file_totals else ["year", "column_name"]
    detail = parsed.where("not is_monthly")
    totals = reshape.daily_totals(detail, keys, "date", "time_period", "value", count_existing_totals=count_existing_totals)
    totals = totals.withColumns({"row_idx": F.lit(-1).cast("bigint"), "is_detail": F.lit(False), "sort_month": F.month("date")})
    if not per_file_totals:
        totals = totals.withColumn("file", F.lit(""))
    rows = parsed.withColumns({"is_detail": F.lit(True), "sort_month": F.col("month").cast("int")})
    long = rows.select(*ROW_KEYS, "column_name", "value").unionByName(totals.select(*ROW_KEYS, "column_name", "value"))
    return long, problems


def number_years(wide: DataFrame) -> DataFrame:
    """Ids ``YR2023-0001`` by month, period, date; ties keep file and row order, totals first."""
    ranked = wide.withColumn("_rank", labels.period_rank(F.col("time_period")))
    order = ["sort_month", "_rank", "date", "file", "is_detail", "row_idx"]
    numbered = ids.number_within(ranked, ["year"], order, "_n")
    return numbered.withColumn("id", ids.padded_id(F.concat(F.lit("YR"), F.col("year")), F.col("_n"))).drop("_rank", "_n")


def parse_ridership(grid: DataFrame, strict: bool = True, columns: Sequence[str] | None = None,
                    count_existing_totals: bool = False, per_file_totals: bool = True,
                    unreadable: DataFrame | None = None) -> Ridership:
    """All sheets of a grid.  With ``strict`` a year with any problem is left out as a whole.

    ``unreadable`` are (file, problem) of sheets that gave no grid: problems of their years as well.
    """
    long, problems = long_rows(grid, count_existing_totals, per_file_totals)
    of_file = grid.select("file").distinct()
    if unreadable is not None:
        problems = problems.unionByName(unreadable)
        of_file = of_file.unionByName(unreadable.select("file")).distinct()
    of_file = of_file.withColumn("year", labels.file_year(_stem(F.col("file"))))
    bad = cut_lineage(problems.join(of_file, "file").groupBy("year").agg(
        F.count("*").alias("problems"), F.array_sort(F.collect_set("problem")).alias("kinds")))
    status = (
        of_file.where("year is not null").groupBy("year").agg(F.count("*").alias("files"))
        .join(bad, "year", "left")
        .select("year", "files", F.coalesce("problems", F.lit(0)).alias("problems"), "kinds",
                (F.col("problems").isNull() | F.lit(not strict)).alias("accepted"))
    )
    good = long.join(status.where("accepted").select("year"), "year", "left_semi")
    columns = reshape.column_names(good, "column_name") if columns is None else columns
    wide = reshape.widen(good, ROW_KEYS, "column_name", "value", columns)
    wide = wide.select(*ROW_KEYS, *[F.col(c).cast("int").alias(c) for c in columns])
    numbered = number_years(wide)
    return Ridership(long, numbered.select("id", "year", "date", "time_period", *columns), status)


def load_ridership(spark: SparkSession, folder: str, main: str, backup: str, now: Column,
                   mode: str = "by_date", strict: bool = True) -> Ridership:
    """Read a folder of sheets and merge them into the table and its backup.

    ``by_date`` identifies a row by date and period; ``reference`` by its running id, so that a
    later load of the same year only touches the rows that have those ids.
    """
    name = F.element_at(F.split(F.url_decode(F.col("file")), "/"), -1)
    wanted = ~name.startswith("~$") & F.lower(_stem(F.col("file"))).contains("afcs")
    books = cut_lineage(files.read_workbook_grid(spark, folder, strict=False).where(wanted))
    grid = files.read_grid(spark, folder).where(wanted)
    grid = grid.unionByName(books.where("problem is null").drop("problem"))
    return store_ridership(grid, main, backup, now, mode, strict, books.where("problem is not null").select("file", "problem"))


def store_ridership(grid: DataFrame, main: str, backup: str, now: Column, mode: str = "by_date", strict: bool = True,
                    unreadable: DataFrame | None = None) -> Ridership:
    """Merge the sheets of a grid into the table and its backup, one partition per year.

    A year is the unit of a commit: only the partitions of accepted years are read, merged and
    replaced, a rejected year keeps what was stored.  Columns that one side lacks are NULL there.
    """
    parsed = parse_ridership(grid, strict, per_file_totals=mode == "reference",
                             count_existing_totals=mode == "reference", unreadable=unreadable)
    key = ["id"] if mode == "reference" else ["date", "time_period"]
    new = parsed.wide.withColumn("load_timestamp", now)
    if mode != "reference":
        new = dedupe.keep_first(new, key, ["id"])
    stored = tables.read_table(grid.sparkSession, main)
    if stored is not None:
        # one entry per accepted year: a filter on partitions, which the scan prunes by
        years = [r["year"] for r in parsed.status.where("accepted").select("year").collect()]
        new = merge.insert_or_touch(stored.where(F.col("year").isin(years)), new, key, "load_timestamp", now)
    tables.write_twice(new, main, backup, ["year"])
    return parsed
