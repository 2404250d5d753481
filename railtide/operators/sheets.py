"""Blocks of a headerless sheet: where they start and end, what their columns mean, their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import cells, labels
from railtide.functions.text import contains_any, let, strip
from railtide.operators.scan import CHUNK_ROWS, carry_forward, chunked
from railtide.session import cut_lineage

LOOK_BACK = 5
SPAN = 64


def is_station_row(first: Column) -> Column:
    return F.coalesce(F.lower(strip(first)) == "station", F.lit(False))


def first_label(cell_array: Column) -> Column:
    """First service period named in a row, left to right."""
    found = F.get(F.filter(F.transform(cell_array, labels.period_label), lambda x: x.isNotNull()), F.lit(0))
    marks = [tokens[-1] for _, tokens in vocab.FUZZY_PERIODS]
    worth_a_look = let(F.lower(F.array_join(cell_array, " ")), lambda row: contains_any(row, marks))
    return F.when(worth_a_look, found)


def marks(grid: DataFrame) -> DataFrame:
    """The few rows that shape a sheet: ``Station`` rows, period labels and entry/exit or Time rows.

    Only station and entry/exit rows keep their cells.
    """
    first = F.get("cells", F.lit(0))
    metric = F.exists("cells", lambda c: labels.identifier(c, {}).isin("entry", "exit"))
    time_row = F.coalesce(labels.identifier(first) == "time", F.lit(False))
    flagged = grid.select(
        "file", "row_idx", "cells", is_station_row(first).alias("is_station"),
        (is_station_row(first) | labels.period_label(first).isNotNull()).alias("is_stop"),
        first_label(F.col("cells")).alias("row_label"), (F.coalesce(metric, F.lit(False)) | time_row).alias("is_metric"),
    )
    return flagged.where(F.col("is_stop") | F.col("is_metric") | F.col("row_label").isNotNull()).withColumn(
        "cells", F.when(F.col("is_station") | F.col("is_metric"), F.col("cells")))


def blocks(grid: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per header: header_idx, period, column names, is_monthly, and where its rows are.

    A ``Station`` row starts a block unless the row above started one.  Its rows run from two below
    the header (body_start) up to the next ``Station`` row or label of a period (body_end,
    exclusive, NULL for the end of the sheet).  The period is the nearest label in the five rows
    above the header.  All scans share one cut into chunks of ``chunk_rows`` marked rows.
    """
    # the marks are written down: a range partitioning evaluates its input twice, and reading cells is what costs
    found = chunked(cut_lineage(marks(grid)), ["file"], "row_idx", "_scan", chunk_rows)
    here, scan = F.col("row_idx"), F.col("_scan")
    above = carry_forward(
        found, ["file"], "row_idx",
        {
            "before": F.struct(here.alias("idx"), F.col("is_station").alias("is_station")),
            "above": F.when(F.col("row_label").isNotNull(), F.struct(here.alias("idx"), F.col("row_label").alias("label"))),
        },
        scan, include_current=False,
    )
    follows = F.coalesce(F.col("before.is_station") & (F.col("before.idx") == here - 1), F.lit(False))
    runs = carry_forward(
        above, ["file"], "row_idx", {"run_start": F.when(F.col("is_station") & ~follows, here)}, scan)
    # every second row of a run of Station rows is a header
    headed = runs.withColumns({
        "is_header": F.col("is_station") & ((here - F.col("run_start")) % 2 == 0),
        "period": F.when(here - F.col("above.idx") <= LOOK_BACK, F.col("above.label")),
    })
    owned = carry_forward(
        headed, ["file"], "row_idx", {"owner": F.when(F.col("is_header"), here)}, scan, include_current=False)
    owned = cut_lineage(owned)
    head = F.col("is_header")
    ends = owned.where(F.col("is_stop") & (here >= F.col("owner") + 2)).groupBy("file", F.col("owner").alias("header_idx")).agg(
        F.min("row_idx").alias("body_end"))
    metrics = owned.where(F.col("is_metric") & (here == F.col("owner") + 1)).select(
        "file", F.col("owner").alias("header_idx"), F.col("cells").alias("metrics"))
    heads = (
        owned.where(head).select("file", here.alias("header_idx"), "period", F.col("cells").alias("stations"))
        .join(ends, ["file", "header_idx"], "left").join(metrics, ["file", "header_idx"], "left")
    )
    time_row = labels.identifier(F.get("metrics", F.lit(0))) == "time"
    heads = heads.withColumns({
        "is_monthly": F.coalesce(time_row, F.lit(False)), "body_start": F.col("header_idx") + 2,
    })
    return _named_columns(heads, _station_metric(F.col("stations"), F.col("metrics")))


def place_rows(grid: DataFrame, heads: DataFrame, keep: list[str]) -> DataFrame:
    """Rows that lie in the body of a block, with columns ``keep`` of the block.

    Blocks are cut into short spans of rows, so the range test is an equi-join on (file, span)
    that compares a row with the few blocks of its span, and no file meets in one task.
    """
    last = grid.groupBy(F.col("file").alias("_file")).agg(F.max("row_idx").alias("_last"))
    spans = heads.join(last, F.col("file") == F.col("_file")).select(
        "_file", *keep, F.col("body_start").alias("_from"), F.coalesce(F.col("body_end") - 1, F.col("_last")).alias("_to"),
    ).where("_from <= _to")
    spans = spans.withColumn("_span", F.explode(F.sequence(F.floor(F.col("_from") / SPAN), F.floor(F.col("_to") / SPAN))))
    rows = grid.withColumn("_row_span", F.floor(F.col("row_idx") / SPAN))
    inside = (
        (F.col("file") == F.col("_file")) & (F.col("_row_span") == F.col("_span"))
        & F.col("row_idx").between(F.col("_from"), F.col("_to"))
    )
    return rows.join(spans, inside).select(*grid.columns, *keep)


def _station_metric(stations: Column, metrics: Column) -> Column:
    """Name per column: the last station at or left of it (from the third on) and entry or exit."""
    def name(metric: Column, at: Column) -> Column:
        left = F.filter(F.slice(stations, F.lit(3), F.greatest(at - 1, F.lit(0))), lambda s: s.isNotNull())
        kind = labels.identifier(metric)
        return F.when(
            kind.isin("entry", "exit"), F.concat_ws("_", labels.identifier(F.try_element_at(left, F.lit(-1))), kind)
        )

    return F.transform(metrics, lambda m, i: F.when((i >= 2) & m.isNotNull(), name(m, i)))


def _alternating(stations: Column) -> Column:
    """Name per column: entry and exit take turns from each station cell on (from the second column)."""
    marks = F.transform(stations, lambda s, i: F.when(s.isNotNull() & (i >= 1), i))

    def name(at: Column) -> Column:
        start = F.array_max(F.slice(marks, F.lit(1), at + 1))
        kind = F.when((at - start) % 2 == 0, F.lit("entry")).otherwise(F.lit("exit"))
        return F.when(start.isNotNull(), F.concat_ws("_", labels.identifier(F.get(stations, start)), kind))

    return F.transform(stations, lambda s, i: name(i))


def _last_of_each(names: Column) -> Column:
    """Where a name repeats, only its last column counts."""
    return F.transform(
        names,
        lambda n, i: F.when(~F.array_contains(F.slice(names, i + 2, F.size(names)), n) | n.isNull(), n),
    )


def _named_columns(df: DataFrame, names: Column) -> DataFrame:
    return df.withColumn("_names", names).withColumn("columns", _last_of_each(F.col("_names"))).drop("_names")


def _cells_long(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per named column: name, value and why a value was rejected."""
    paired = F.filter(
        F.transform(F.col("columns"), lambda n, i: F.struct(n.alias("column_name"), F.get(F.col("cells"), i).alias("cell"))),
        lambda p: p["column_name"].isNotNull(),
    )
    long = rows.select(*keep, F.inline(paired))
    return long.select(
        *keep, "column_name", cells.optional_int(F.col("cell")).alias("value"),
        cells.optional_int_reject(F.col("cell")).alias("reject_reason"),
    )


def period_rows(grid: DataFrame, heads: DataFrame, year: Column) -> DataFrame:
    """Long rows of the daily blocks: file, row_idx, date, time_period, column_name, value, reject_reason.

    A row whose first cell has the shape of a date but is none in that year is rejected as bad_date.
    """
    usable = heads.where(~F.col("is_monthly")).withColumnRenamed("period", "time_period")
    placed = place_rows(grid, usable, ["time_period", "columns"])
    first = F.get("cells", F.lit(0))
    dated = placed.withColumns({
        "date": labels.service_date(first, year), "bad_date": labels.service_date_reject(first, year),
    }).where("date is not null or bad_date is not null")
    long = _cells_long(dated, ["file", "row_idx", "date", "time_period", "bad_date"])
    return long.withColumn("reject_reason", F.coalesce("bad_date", "reject_reason")).drop("bad_date")


def monthly_rows(grid: DataFrame, heads: DataFrame, year: Column, month: Column) -> DataFrame:
    """Long rows of monthly summaries, dated the first of the month.

    Hour rows run from two below the header to the first row without a period; a ``Peak Hours``
    row further down heads a second run with its own columns.
    """
    first_head = heads.where("is_monthly").groupBy("file").agg(F.min("header_idx").alias("head"))
    rows = grid.join(first_head, "file").where(F.col("row_idx") >= F.col("head"))
    zero = F.get("cells", F.lit(0))
    rows = cut_lineage(rows.withColumns({
        "label": labels.row_period_label(zero),
        "is_peak": F.coalesce(labels.identifier(zero) == "peak_hours", F.lit(False)),
    }))
    open_row = F.col("label").isNull() & (F.col("row_idx") >= F.col("head") + 2)
    ends = rows.groupBy("file").agg(
        F.min(F.when(open_row, F.col("row_idx"))).alias("hours_end"), F.max(F.size("cells")).alias("width")
    )
    peaks = (
        rows.where("is_peak").join(ends, "file").where("row_idx >= hours_end")
        .groupBy("file").agg(F.min("row_idx").alias("peak"))
    )
    peak_ends = (
        rows.join(peaks, "file").where(F.col("label").isNull() & (F.col("row_idx") > F.col("peak")))
        .groupBy("file").agg(F.min("row_idx").alias("peak_end"))
    )
    bounds = first_head.join(ends, "file", "left").join(peaks, "file", "left").join(peak_ends, "file", "left")
    big = F.lit(2**62)
    placed = rows.drop("head").join(bounds, "file")
    at = F.col("row_idx")
    in_hours = (at >= F.col("head") + 2) & (at < F.coalesce("hours_end", big))
    in_peak = (at > F.col("peak")) & (at < F.coalesce("peak_end", big))
    placed = placed.withColumn("source_row", F.when(in_hours, F.col("head")).when(in_peak, F.col("peak")))
    width = F.col("width")
    padded = F.concat("cells", F.array_repeat(F.lit(None).cast("string"), width - F.size("cells")))
    starts = placed.where((at == F.col("head")) | (at == F.col("peak"))).select("file", F.col("row_idx").alias("source_row"), padded.alias("stations"))
    named = _named_columns(starts, _alternating(F.col("stations"))).select("file", "source_row", "columns")
    body = placed.where("source_row is not null").select(
        "file", "row_idx", "source_row", "cells", F.col("label").alias("time_period"),
        F.make_date(year, month, F.lit(1)).alias("date"),
    )
    return _cells_long(body.join(named, ["file", "source_row"]), ["file", "row_idx", "date", "time_period"])


def sheet_problems(heads: DataFrame, long: DataFrame) -> DataFrame:
    """(file, problem): blocks without period or columns, and rejected cells."""
    no_names = F.size(F.array_compact(F.coalesce("columns", F.array().cast("array<string>")))) == 0
    daily = heads.where(~F.col("is_monthly"))
    return (
        daily.where("period is null").select("file", F.lit("no_period").alias("problem"))
        .unionByName(daily.where(no_names).select("file", F.lit("no_columns").alias("problem")))
        .unionByName(long.where("reject_reason is not null").select("file", F.col("reject_reason").alias("problem")))
    )
