"""Long and wide forms: unpivot, pivot with known columns, totals and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import cells, labels
from railtide.operators.ids import padded_id
from railtide.session import cut_lineage

LAST_COLUMNS = ["total_entry", "total_exit"]


def month_matrix(df: DataFrame, month: str, years: Sequence[str]) -> DataFrame:
    """Month x year sheet to rows (year, month_number, month_name, is_total, value, reject_reason).

    Blank cells vanish; the TOTAL row is kept without a month; other labels are ignored.
    """
    ids = [month, *[c for c in df.columns if c == "row_idx"]]
    long = df.select(*ids, *[F.col(f"`{y}`").cast("string").alias(y) for y in years]).unpivot(
        ids, list(years), "_year", "_cell"
    )
    label = F.upper(F.btrim(F.col(month)))
    number = labels.lookup(label, {m: i for i, m in enumerate(vocab.FULL_MONTHS, start=1)})
    out = long.select(
        cells.header_year(F.col("_year")).alias("year"),
        number.alias("month_number"),
        F.initcap(label).alias("month_name"),
        (label == "TOTAL").alias("is_total"),
        cells.optional_int(F.col("_cell")).alias("value"),
        F.coalesce(
            F.when(cells.header_year(F.col("_year")).isNull(), F.lit("bad_year")),
            cells.optional_int_reject(F.col("_cell")),
        ).alias("reject_reason"),
        *[F.col(c) for c in ids if c == "row_idx"],
    )
    return out.where(
        (F.col("month_number").isNotNull() | F.col("is_total"))
        & (F.col("value").isNotNull() | F.col("reject_reason").isNotNull())
    )


def number_months(df: DataFrame, prefix: str = "STU") -> DataFrame:
    """Ids of a month matrix: a running number per year over the months kept, TOTAL by name.

    A year keeps at most one row per label, so the number is the count of smaller kept months and
    needs a window over at most twelve rows; sheets that repeat a month fall back on row order.
    """
    from pyspark.sql import Window

    order = "row_idx" if "row_idx" in df.columns else "month_number"
    place = F.row_number().over(Window.partitionBy("year", "is_total").orderBy(order))
    family = F.concat(F.lit(prefix), F.col("year"))
    named = F.when(F.col("is_total"), F.concat(family, F.lit("-TOTAL"))).otherwise(padded_id(family, place))
    return df.withColumn("id", named)


def column_names(df: DataFrame, name: str) -> list[str]:
    """Distinct column names of a long table, in sheet order: sorted, grand totals last.

    They are a table's schema, which the driver holds in any case.
    """
    found = sorted(r[name] for r in df.select(name).where(F.col(name).isNotNull()).distinct().collect())
    return [c for c in found if c not in LAST_COLUMNS] + [c for c in LAST_COLUMNS if c in found]


def widen(df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None,
          agg=F.max) -> DataFrame:
    """Long to wide with explicit columns, one aggregation and no job to find the values."""
    columns = column_names(df, name) if columns is None else list(columns)
    return df.groupBy(*keys).agg(
        *[agg(F.when(F.col(name) == c, F.col(value))).alias(c) for c in columns]
    )


TOTAL_LABELS = [vocab.DAILY_TOTAL, vocab.PEAK_TOTAL, vocab.OFF_PEAK_TOTAL, vocab.MONTHLY_TOTAL]


def daily_totals(detail: DataFrame, keys: Sequence[str], date: str, period: str, value: str,
                 total_label: str = vocab.DAILY_TOTAL, count_existing_totals: bool = False) -> DataFrame:
    """Per-day sums over periods, labelled as a total.

    Sums ignore NULLs, and a total exists only where some value does.  Rows already labelled as a
    total are left out of the sum unless ``count_existing_totals``.
    """
    summed = detail.where(F.col(value).isNotNull())
    if not count_existing_totals:
        summed = summed.where(~F.coalesce(F.col(period).isin(*TOTAL_LABELS), F.lit(False)))
    return (
        summed.groupBy(*keys, date).agg(F.sum(value).cast(dict(detail.dtypes)[value]).alias(value))
        .withColumn(period, F.lit(total_label))
    )


def with_daily_totals(detail: DataFrame, keys: Sequence[str], date: str, period: str, value: str, **options) -> DataFrame:
    """Daily totals and the detail rows in one table; what made the detail rows runs once."""
    detail = cut_lineage(detail)
    totals = daily_totals(detail, keys, date, period, value, **options)
    return totals.unionByName(detail.select(*totals.columns))


def union_filled(frames: Sequence[DataFrame], columns: Sequence[str] | None = None, fill: Column | None = None) -> DataFrame:
    """Union by name; columns a frame lacks are NULL or ``fill``; optional fixed projection."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    if columns is None:
        return out
    made = [F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns]
    out = out.select(*made)
    return out.select(*[F.coalesce(F.col(c).cast("string"), fill).alias(c) for c in columns]) if fill is not None else out


def forward_fill_blank(df: DataFrame, group: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Continuation rows of a printed table take blank cells from the row above."""
    from railtide.operators.scan import carry_forward

    filled = carry_forward(df, group, order, {f"_v_{c}": F.nullif(F.btrim(c), F.lit("")) for c in columns})
    return filled.select(*[F.col(f"_v_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])
