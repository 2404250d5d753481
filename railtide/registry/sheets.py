"""Queries on sheet-shaped data: periods, totals, blocks, cells, ids."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import cells, labels
from railtide.operators import checks, ids, reshape, sheets
from railtide.plans import ridership
from railtide.registry.base import pick, query
from railtide.session import cut_lineage
from railtide.sinks import tables
from railtide.sources import files

PRIORITY_PERIODS = {
    "1-URGENT": vocab.AM_PEAK, "2-HIGH": vocab.PM_PEAK, "3-MEDIUM": vocab.EARLY_OFF_PEAK,
    "4-NOT SPECIFIED": vocab.MIDDAY_OFF_PEAK, "5-LOW": vocab.LATE_OFF_PEAK_10,
}
SQL_PERIODS = "CASE o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_PERIODS.items()
) + " END"
SQL_RANKS = "CASE time_period " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in vocab.PERIOD_RANK.items()
) + f" ELSE {vocab.UNKNOWN_PERIOD_RANK} END"


def order_periods(orders):
    """Orders as ridership: status is the station column, priority the period of the day."""
    return orders.select(
        F.to_date("o_orderdate").alias("date"),
        labels.lookup(F.col("o_orderpriority"), PRIORITY_PERIODS).alias("time_period"),
        F.concat(F.lower("o_orderstatus"), F.lit("_entry")).alias("column_name"),
        F.floor("o_totalprice").cast("bigint").alias("value"),
    ).groupBy("date", "time_period", "column_name").agg(F.sum("value").alias("value"))


SQL_DETAIL = f"""
detail AS (
  SELECT CAST(o_orderdate AS DATE) AS date, {SQL_PERIODS} AS time_period,
         lower(o_orderstatus) || '_entry' AS column_name,
         CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS value
  FROM orders GROUP BY ALL),
totals AS (
  SELECT date, 'Daily Total' AS time_period, column_name, CAST(sum(value) AS BIGINT) AS value
  FROM detail GROUP BY ALL)
"""


@query("daily_totals_union", f"""
WITH {SQL_DETAIL},
wide AS (
  SELECT date, time_period,
         max(value) FILTER (WHERE column_name = 'f_entry') AS f_entry,
         max(value) FILTER (WHERE column_name = 'o_entry') AS o_entry,
         max(value) FILTER (WHERE column_name = 'p_entry') AS p_entry
  FROM (SELECT * FROM detail UNION ALL SELECT * FROM totals) GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY year(date) ORDER BY month(date), {SQL_RANKS}, date) AS n FROM wide)
SELECT 'YR' || year(date) || '-' || printf('%04d', n) AS id, strftime(date, '%Y-%m-%d') AS service_date,
       time_period, f_entry, o_entry, p_entry
FROM numbered
""")
def daily_totals_union(table, spark):
    long = reshape.with_daily_totals(order_periods(table("orders")), ["column_name"], "date", "time_period", "value")
    wide = reshape.widen(long, ["date", "time_period"], "column_name", "value", ["f_entry", "o_entry", "p_entry"])
    wide = wide.withColumns({
        "year": F.year("date"), "month": F.month("date"), "rank": labels.period_rank(F.col("time_period")),
    })
    numbered = ids.number_within(wide, ["year"], ["month", "rank", "date"], "n")
    return numbered.select(
        ids.padded_id(F.concat(F.lit("YR"), F.col("year")), F.col("n")).alias("id"),
        F.date_format("date", "yyyy-MM-dd").alias("service_date"), "time_period", "f_entry", "o_entry", "p_entry",
    )


@query("period_pivot", f"""
WITH {SQL_DETAIL}
SELECT strftime(date, '%Y-%m') AS service_month, time_period,
       CAST(sum(value) FILTER (WHERE column_name = 'f_entry') AS BIGINT) AS f_entry,
       CAST(sum(value) FILTER (WHERE column_name = 'o_entry') AS BIGINT) AS o_entry,
       CAST(sum(value) FILTER (WHERE column_name = 'p_entry') AS BIGINT) AS p_entry
FROM detail GROUP BY ALL
""")
def period_pivot(table, spark):
    long = order_periods(table("orders")).withColumn("service_month", F.date_format("date", "yyyy-MM"))
    names = table("orders").select(F.concat(F.lower("o_orderstatus"), F.lit("_entry")).alias("column_name"))
    columns = reshape.column_names(names, "column_name")
    return reshape.widen(long, ["service_month", "time_period"], "column_name", "value", columns, F.sum)


YEARS = [str(y) for y in range(1992, 2003)]


@query("unpivot_month_year", """
WITH m AS (
  SELECT year(o_orderdate) AS year, month(o_orderdate) AS month_number,
         strftime(o_orderdate, '%B') AS month_name, count(*) AS value
  FROM orders GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY month_number) AS n FROM m)
SELECT 'STU' || year || '-' || printf('%04d', n) AS id, CAST(year AS INTEGER) AS year,
       CAST(month_number AS INTEGER) AS month_number, month_name, false AS is_total, value FROM numbered
UNION ALL
SELECT 'STU' || year || '-TOTAL', CAST(year AS INTEGER), NULL, 'Total', true, CAST(sum(value) AS BIGINT)
FROM m GROUP BY year
""")
def unpivot_month_year(table, spark):
    counted = table("orders").groupBy(
        F.upper(F.date_format("o_orderdate", "MMMM")).alias("Month"), F.year("o_orderdate").cast("string").alias("y"),
    ).agg(F.count("*").alias("n"))
    with_total = counted.unionByName(counted.groupBy("y").agg(F.sum("n").alias("n")).withColumn("Month", F.lit("TOTAL")))
    matrix = reshape.widen(with_total.withColumn("n", F.format_number("n", 0)), ["Month"], "y", "n", YEARS)
    return reshape.number_months(reshape.month_matrix(matrix, "Month", YEARS)).select(
        "id", "year", "month_number", "month_name", "is_total", "value"
    )


def event_grid(events):
    """Events as headerless sheets, one per user: the event type decides what a row looks like."""
    none = F.lit(None).cast("string")
    row = (
        F.when(F.col("event_type") == "signup", F.array(F.lit(" Station"), none, F.lit("Recto"), none, F.lit("Betty Go"), none))
        .when(F.col("event_type") == "error", F.array(F.lit("Date"), F.lit("Day"), F.lit("Entry"), F.lit("Exit"), F.lit("Entry"), F.lit("exit ")))
        .when(
            (F.col("event_type") == "view") & (F.col("event_id") % 3 == 0),
            F.array(none, F.lit("Counts 5-7pm (PM Peak)"), none, none, none, none),
        )
        .when(
            (F.col("event_type") == "view") & (F.col("event_id") % 3 == 1),
            F.array(F.lit("7-9am  (am PEAK)"), none, none, none, none, none),
        )
        .otherwise(F.array(
            F.date_format("ts", "d-MMM"), F.date_format("ts", "EEE"), F.format_number(F.col("event_id"), 0),
            F.lit("-"), F.floor("value").cast("string"), none,
        ))
    )
    # cells are made once rows have their numbers, so that they are neither sampled nor sorted
    plain = events.select(F.concat(F.lit("u"), F.col("user_id")).alias("file"), "event_id", "event_type", "ts", "value")
    numbered = ids.number_within(plain, ["file"], ["event_id"], "row_no")
    return cut_lineage(numbered.select("file", (F.col("row_no") - 1).alias("row_idx"), row.alias("cells")))


SQL_SEGMENTS = """
grid AS (
  SELECT 'u' || user_id AS file, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS row_idx,
         event_type, event_id, ts, value,
         event_type = 'signup' AS is_station,
         CASE WHEN event_type = 'view' AND event_id % 3 = 0 THEN '5-7pm (PM PEAK)'
              WHEN event_type = 'view' AND event_id % 3 = 1 THEN '7-9am (AM PEAK)' END AS row_label,
         event_type = 'signup' OR (event_type = 'view' AND event_id % 3 = 1) AS is_stop
  FROM events),
runs AS (
  SELECT *,
    max(CASE WHEN NOT is_station THEN row_idx END) OVER up AS other_idx,
    max(CASE WHEN row_label IS NOT NULL THEN row_idx END) OVER up AS label_idx,
    last_value(row_label IGNORE NULLS) OVER up AS label_above
  FROM grid WINDOW up AS (PARTITION BY file ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
heads AS (
  SELECT *, is_station AND (row_idx - coalesce(other_idx, -1) - 1) % 2 = 0 AS is_header,
    CASE WHEN row_idx - label_idx <= 5 THEN label_above END AS header_period
  FROM runs),
segs AS (
  SELECT *, max(CASE WHEN is_header THEN row_idx END) OVER w AS header_idx,
    max(CASE WHEN is_stop THEN row_idx END) OVER w AS stop_idx
  FROM heads WINDOW w AS (PARTITION BY file ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
seg AS (
  SELECT *, coalesce(row_idx >= header_idx + 2 AND coalesce(stop_idx < header_idx + 2, false), false) AS in_block FROM segs)
"""


@query("sheet_blocks", f"""
WITH {SQL_SEGMENTS}
SELECT h.file, h.row_idx AS header_idx, h.header_period AS period,
  (SELECT count(*) FROM seg r WHERE r.file = h.file AND r.header_idx = h.row_idx AND r.in_block) AS n_rows
FROM seg h WHERE h.is_header
""")
def sheet_blocks(table, spark):
    grid = event_grid(table("events"))
    heads = sheets.blocks(grid, chunk_rows=2)
    counted = sheets.place_rows(grid, heads, ["header_idx"]).groupBy("file", "header_idx").agg(F.count("*").alias("n_rows"))
    return heads.select("file", "header_idx", "period").join(counted, ["file", "header_idx"], "left").fillna(0, ["n_rows"])


@query("sheet_ridership", f"""
WITH {SQL_SEGMENTS},
blocks AS (
  SELECT h.file, h.row_idx AS header_idx, h.header_period AS time_period
  FROM seg h JOIN seg m ON m.file = h.file AND m.row_idx = h.row_idx + 1
  WHERE h.is_header AND m.event_type = 'error'),
body AS (
  SELECT s.file, s.row_idx, '2023-' || strftime(s.ts, '%m-%d') AS date, b.time_period, s.event_id, s.value
  FROM seg s JOIN blocks b ON s.file = b.file AND s.header_idx = b.header_idx
  WHERE s.in_block AND s.event_type IN ('click', 'purchase') OR (s.in_block AND s.event_type = 'view' AND s.event_id % 3 = 2)),
cell AS (
  SELECT file, date, time_period, 'recto_entry' AS column_name, event_id AS value FROM body
  UNION ALL SELECT file, date, time_period, 'recto_exit', NULL FROM body
  UNION ALL SELECT file, date, time_period, 'betty_go_belmonte_entry', CAST(floor(value) AS BIGINT) FROM body
  UNION ALL SELECT file, date, time_period, 'betty_go_belmonte_exit', NULL FROM body)
SELECT file, date, time_period, column_name, value FROM cell
UNION ALL
SELECT file, date, 'Daily Total', column_name, CAST(sum(value) AS BIGINT) FROM cell WHERE value IS NOT NULL GROUP BY ALL
""")
def sheet_ridership(table, spark):
    grid = event_grid(table("events"))
    long = sheets.period_rows(grid, sheets.blocks(grid), F.lit(2023))
    long = long.select("file", F.date_format("date", "yyyy-MM-dd").alias("date"), "time_period", "column_name", "value")
    return reshape.with_daily_totals(long, ["file", "column_name"], "date", "time_period", "value")


@query("raw_sheet", """
SELECT event_id, user_id % 8 AS book, row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) - 1 AS row_idx,
  CASE event_id % 5 WHEN 0 THEN 2 ELSE 4 END AS n_cells,
  CASE event_id % 3 WHEN 0 THEN event_type || chr(10) || 'said "' || user_id || '", twice' || chr(10) WHEN 1 THEN '5" pipe' ELSE event_type END AS note,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN 'v,' || event_id END AS mark
FROM events
""")
def raw_sheet(table, spark):
    """Events as headerless books whose quoted cells hold commas, quotes and line breaks, written and read in many splits."""
    event, user = F.col("event_id"), F.col("user_id")
    spoken = F.concat(F.lit('"'), "event_type", F.lit('\nsaid ""'), user, F.lit('"", twice\n"'))
    note = pick(event % 3, spoken, F.lit('5" pipe'), F.col("event_type"))
    rest = F.when(event % 5 == 0, "").otherwise(F.concat(F.lit(',"'), F.when(event % 7 == 0, " ").otherwise(F.concat(F.lit("v,"), event)), F.lit('",x')))
    books = table("events").select((user % 8).alias("book"), event, F.concat(event, F.lit(","), note, rest).alias("value"))
    folder = f"{spark.sparkContext.getCheckpointDir()}/raw-sheet-{uuid.uuid4().hex}"
    books.repartition(8, "book").sortWithinPartitions("book", "event_id").drop("event_id").write.partitionBy("book").text(folder)
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 14))  # many splits in small books
    try:
        grid = cut_lineage(files.read_grid(spark, folder, "*.txt"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)
    return grid.select(
        F.get("cells", F.lit(0)).cast("bigint").alias("event_id"), F.regexp_extract("file", r"book=(\d+)", 1).cast("bigint").alias("book"),
        "row_idx", F.size("cells").alias("n_cells"), F.get("cells", F.lit(1)).alias("note"), F.get("cells", F.lit(2)).alias("mark"),
    )


def order_sheets(orders, stations=("Recto",), years=None):
    """Orders as one ridership sheet per month, twelve years later; the fifteenths of 2007 hold a negative cell."""
    day = F.col("o_orderdate")
    year, month = F.year(day) + 12, F.month(day)
    daily = orders.groupBy(day.alias("day"), year.alias("year"), month.alias("month")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_custkey") % 7).alias("m"))
    if years is not None:
        daily = daily.where(F.col("year").isin(*years))
    bad = (F.col("year") == 2007) & (F.dayofmonth("day") == 15)
    entry = F.when(bad, F.lit("-1")).otherwise(F.format_number("n", 0))
    none = F.lit(None).cast("string")
    wide = F.array(
        F.date_format("day", "d-MMM"), F.date_format("day", "EEE"), *[c for _ in stations for c in (entry, F.col("m").cast("string"))])
    heads = [
        F.array(F.lit("Counts 7-9am (AM Peak)")), F.array(F.lit(" Station"), none, *[c for s in stations for c in (F.lit(s), none)]),
        F.array(F.lit("Date"), F.lit("Day"), *[F.lit(c) for _ in stations for c in ("Entry", "Exit")]),
    ]
    file = F.concat(F.lit("afcs_"), F.lower(F.date_format(F.make_date(F.lit(2000), "month", F.lit(1)), "MMMM")), F.lit("_"), "year", F.lit(".csv"))
    top = daily.select("year", "month").distinct().select(file.alias("file"), F.posexplode(F.array(*heads)).alias("row_idx", "cells"))
    body = daily.select(file.alias("file"), (F.dayofmonth("day") + 2).alias("row_idx"), wide.alias("cells"))
    return cut_lineage(top.unionByName(body).withColumn("row_idx", F.col("row_idx").cast("bigint")))


@query("year_load", f"""
WITH d AS (SELECT o_orderdate AS day, CAST(year(o_orderdate) + 12 AS INTEGER) AS year, count(*) AS n, CAST(sum(o_custkey % 7) AS BIGINT) AS m FROM orders GROUP BY ALL),
s AS (SELECT year, year <> 2007 AS accepted, count(*) FILTER (WHERE year = 2007 AND day(day) = 15) AS problems FROM d GROUP BY 1),
p AS (SELECT unnest(['{vocab.AM_PEAK}', '{vocab.DAILY_TOTAL}']) AS time_period)
SELECT s.year, s.accepted, s.problems, CASE WHEN accepted THEN d.year || '-' || strftime(d.day, '%m-%d') END AS service_date,
  time_period, CAST(CASE WHEN accepted THEN n END AS INTEGER) AS recto_entry, CAST(CASE WHEN accepted THEN m END AS INTEGER) AS recto_exit,
  CAST(CASE WHEN accepted AND s.year = 2010 AND time_period = '{vocab.AM_PEAK}' THEN NULL END AS INTEGER) AS legarda_entry,
  CASE WHEN accepted THEN CASE WHEN s.year IN (2009, 2010) THEN '2024-02-02' ELSE '2024-02-01' END END AS loaded
FROM d JOIN s USING (year) CROSS JOIN p WHERE accepted
UNION ALL SELECT year, accepted, problems, NULL, NULL, NULL, NULL, NULL, NULL FROM s WHERE NOT accepted
""")
def year_load(table, spark):
    """All months loaded, then those of two years again with one more station: rows of stored years and the verdict on each."""
    folder = f"{spark.sparkContext.getCheckpointDir()}/year-load-{uuid.uuid4().hex}"
    first, again = (F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp") for d in (1, 2))
    done = ridership.store_ridership(order_sheets(table("orders")), f"{folder}/main", f"{folder}/backup", first)
    later = order_sheets(table("orders"), ("Recto", "Legarda"), (2009, 2010))
    ridership.store_ridership(later, f"{folder}/main", f"{folder}/backup", again)
    stored = tables.read_table(spark, f"{folder}/backup").select(
        F.col("year").alias("stored_year"), F.date_format("date", "yyyy-MM-dd").alias("service_date"), "time_period", "recto_entry",
        "recto_exit", "legarda_entry", F.date_format("load_timestamp", "yyyy-MM-dd").alias("loaded"))
    return done.status.join(stored, F.col("year") == F.col("stored_year"), "left").select(
        F.col("year").cast("int").alias("year"), "accepted", "problems", *stored.columns[1:])


MONTHLY_HOURS = ["07:00-08:00", "08:00-09:00", "17:00-18:00"]


def event_summaries(events):
    """Events as monthly summaries, one sheet per user group: hours, an empty row, then totals under Peak Hours."""
    group = F.col("user_id") % 12 + 1
    counted = events.groupBy(group.alias("month")).agg(
        *[F.count(F.when(F.hour("ts") == h, 1)).alias(f"h{h}") for h in (7, 8, 17)], F.count("*").alias("n"),
        F.sum(F.col("event_id") % 5).alias("m"))
    none = F.lit(None).cast("string")

    def row(label, *values):
        return F.array(F.lit(label), *[v if v is none else v.cast("string") for v in values])

    rows = F.array(
        row("Summary", none, none, none, none), F.array(*map(F.lit, ("Station", "Recto")), none, F.lit("Total"), none),
        F.array(*map(F.lit, ("Time", "Entry", "Exit", "Entry", "Exit"))),
        *[row(label, F.col(h), F.col("m"), F.col("n"), F.lit("-")) for label, h in zip(MONTHLY_HOURS, ("h7", "h8", "h17"))],
        row("", none, none, none, none), F.array(F.lit("Peak Hours"), F.lit("Recto"), none, F.lit("Total"), none),
        row("Subtotal (Peak)", F.col("h7") + F.col("h8"), F.col("m"), F.col("n"), F.col("m")), row("Total", F.col("n"), F.col("m"), F.col("n"), F.lit("")),
        row("", none, none, none, none), row("Total", F.col("m"), F.col("m"), F.col("m"), F.col("m")),
    )
    file = F.concat(F.lit("afcs_"), F.lower(F.date_format(F.make_date(F.lit(2024), "month", F.lit(1)), "MMMM")), F.lit("_2024.csv"))
    return cut_lineage(counted.select(file.alias("file"), F.posexplode(rows).alias("row_idx", "cells")).withColumn(
        "row_idx", F.col("row_idx").cast("bigint")))


@query("monthly_summary", f"""
WITH c AS (SELECT CAST(user_id % 12 + 1 AS INTEGER) AS month, count(*) FILTER (WHERE hour(ts) = 7) AS h7, count(*) FILTER (WHERE hour(ts) = 8) AS h8,
    count(*) FILTER (WHERE hour(ts) = 17) AS h17, count(*) AS n, CAST(sum(event_id % 5) AS BIGINT) AS m FROM events GROUP BY 1),
r AS (
  SELECT month, '{MONTHLY_HOURS[0]}' AS time_period, [h7, m, n, NULL] AS v FROM c UNION ALL SELECT month, '{MONTHLY_HOURS[1]}', [h8, m, n, NULL] FROM c
  UNION ALL SELECT month, '{MONTHLY_HOURS[2]}', [h17, m, n, NULL] FROM c UNION ALL SELECT month, '{vocab.PEAK_TOTAL}', [h7 + h8, m, n, m] FROM c
  UNION ALL SELECT month, '{vocab.MONTHLY_TOTAL}', [n, m, n, NULL] FROM c)
SELECT '2024-' || printf('%02d', month) || '-01' AS service_date, time_period, unnest(['recto_entry', 'recto_exit', 'total_entry', 'total_exit']) AS column_name,
  unnest(v) AS value FROM r
""")
def monthly_summary(table, spark):
    long, _ = ridership.long_rows(event_summaries(table("events")))
    return long.select(F.date_format("date", "yyyy-MM-dd").alias("service_date"), "time_period", "column_name", F.col("value").cast("bigint").alias("value"))


SHAPES = [
    "7-9am (AM Peak)", "5-7PM  Peak", "5-7am Off", "9am-5pm off-peak", "7-10pm OFF peak", "7-11pm off", "Daily  Total",
    "Sub Total", "07:00-09:00", "1700 - 1900", "Subtotal (Peak)", "Off-Peak Total", "Total (Peak + Off Peak)", "7-9am off peak",
]


@query("period_labels", """
WITH e AS (
  SELECT event_id, CASE WHEN event_id % 15 = 14 THEN hour(ts) || ':00-' || (hour(ts) + 1) || ':00'
    ELSE ['7-9am (AM Peak)', '5-7PM  Peak', '5-7am Off', '9am-5pm off-peak', '7-10pm OFF peak', '7-11pm off', 'Daily  Total',
    'Sub Total', '07:00-09:00', '1700 - 1900', 'Subtotal (Peak)', 'Off-Peak Total', 'Total (Peak + Off Peak)', '7-9am off peak']
    [event_id % 15 + 1] END AS cell FROM events),
n AS (SELECT *, lower(regexp_replace(trim(cell), '\\s+', ' ', 'g')) AS s, lower(regexp_replace(cell, '\\s+', '', 'g')) AS t FROM e),
p AS (SELECT *, CASE
  WHEN contains(s, '7-9am') AND contains(s, 'peak') THEN '7-9am (AM PEAK)'
  WHEN contains(s, '5-7pm') AND contains(s, 'peak') THEN '5-7pm (PM PEAK)'
  WHEN contains(s, '5-7am') AND contains(s, 'off') THEN '5-7am (OFF PEAK)'
  WHEN contains(s, '9am-5pm') AND contains(s, 'off') THEN '9am-5pm (OFF PEAK)'
  WHEN contains(s, '7-10pm') AND contains(s, 'off') THEN '7-10pm (OFF PEAK)'
  WHEN contains(s, '7-11pm') AND contains(s, 'off') THEN '7-11pm (OFF PEAK)'
  WHEN contains(s, 'daily') AND contains(s, 'total') THEN 'Daily Total' END AS period FROM n),
r AS (SELECT *, CASE
  WHEN t IN ('7-9am', '07:00-09:00', '0700-0900') THEN '7-9am (AM PEAK)'
  WHEN t IN ('5-7pm', '17:00-19:00', '1700-1900') THEN '5-7pm (PM PEAK)'
  WHEN t IN ('5-7am', '05:00-07:00', '0500-0700') THEN '5-7am (OFF PEAK)'
  WHEN t IN ('9am-5pm', '09:00-17:00', '0900-1700') THEN '9am-5pm (OFF PEAK)'
  WHEN t IN ('7-10pm', '19:00-22:00', '1900-2200') THEN '7-10pm (OFF PEAK)'
  WHEN t IN ('7-11pm', '19:00-23:00', '1900-2300') THEN '7-11pm (OFF PEAK)'
  WHEN t IN ('subtotal(peak)', 'peaktotal') THEN 'Peak Total'
  WHEN t IN ('subtotal(offpeak)', 'offpeaktotal', 'off-peaktotal') THEN 'Off-Peak Total'
  WHEN t IN ('total', 'total(peak+offpeak)', 'monthlytotal') THEN 'Monthly Total'
  WHEN regexp_full_match(t, '\\d{1,2}:\\d{2}-\\d{1,2}:\\d{2}') THEN trim(cell) ELSE period END AS row_period FROM p)
SELECT event_id, period, row_period, CAST(CASE row_period
  WHEN 'Daily Total' THEN 0 WHEN '7-9am (AM PEAK)' THEN 1 WHEN '5-7pm (PM PEAK)' THEN 2 WHEN '5-7am (OFF PEAK)' THEN 3
  WHEN '9am-5pm (OFF PEAK)' THEN 4 WHEN '7-10pm (OFF PEAK)' THEN 5 WHEN '7-11pm (OFF PEAK)' THEN 6 WHEN 'Peak Total' THEN 20
  WHEN 'Off-Peak Total' THEN 21 WHEN 'Monthly Total' THEN 22
  ELSE coalesce(100 + 60 * TRY_CAST(regexp_extract(row_period, '^(\\d{1,2}):(\\d{2})-', 1) AS INTEGER)
       + TRY_CAST(regexp_extract(row_period, '^(\\d{1,2}):(\\d{2})-', 2) AS INTEGER), 10000) END AS INTEGER) AS rank
FROM r
""".replace("\\\\", "\\"))
def period_labels(table, spark):
    clock = F.concat(F.hour("ts"), F.lit(":00-"), F.hour("ts") + 1, F.lit(":00"))
    shape = F.get(F.array(*[F.lit(s) for s in SHAPES]), (F.col("event_id") % 15).cast("int"))
    out = table("events").select("event_id", F.coalesce(shape, clock).alias("cell"))
    out = out.select("event_id", labels.period_label(F.col("cell")).alias("period"), labels.row_period_label(F.col("cell")).alias("row_period"))
    return out.withColumn("rank", labels.period_rank(F.col("row_period")).cast("int"))


@query("cell_int_clean", """
WITH d AS (
  SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN format('{:,}', c_custkey * 7) WHEN 1 THEN ' - ' WHEN 2 THEN 'n/a'
    WHEN 3 THEN CAST(c_custkey AS VARCHAR) || '.0' WHEN 4 THEN '-' || c_custkey ELSE c_custkey || '.5' END AS cell,
    CAST(c_acctbal / 10000 AS VARCHAR) AS weight FROM customer),
n AS (SELECT *, TRY_CAST(replace(trim(cell), ',', '') AS DOUBLE) AS x,
  CASE WHEN regexp_full_match(cell, '[-+]?[0-9.]+') THEN TRY_CAST(cell AS DOUBLE) END AS y, TRY_CAST(weight AS DOUBLE) AS w FROM d)
SELECT c_custkey, CASE WHEN x >= 0 AND x = floor(x) THEN CAST(x AS BIGINT) END AS int_value,
  CASE WHEN x < 0 THEN 'negative' WHEN x <> floor(x) THEN 'fractional' END AS int_reject,
  CASE WHEN y >= 0 AND y = floor(y) THEN CAST(y AS BIGINT) END AS strict_int,
  CASE WHEN y >= 0 THEN y END AS float_value,
  CASE WHEN y IS NULL THEN 'not_a_number' WHEN y < 0 THEN 'negative' END AS float_reject,
  CASE WHEN w BETWEEN 0 AND 1 THEN round(w, 6) END AS weight,
  CASE WHEN w NOT BETWEEN 0 AND 1 THEN 'out_of_range' END AS weight_reject
FROM n
""")
def cell_int_clean(table, spark):
    key = F.col("c_custkey")
    cell = (
        F.when(key % 6 == 0, F.format_number(key * 7, 0)).when(key % 6 == 1, F.lit(" - ")).when(key % 6 == 2, F.lit("n/a"))
        .when(key % 6 == 3, F.concat(key, F.lit(".0"))).when(key % 6 == 4, F.concat(F.lit("-"), key))
        .otherwise(F.concat(key, F.lit(".5")))
    )
    dirty = table("customer").select("c_custkey", cell.alias("cell"), (F.col("c_acctbal") / 10000).cast("string").alias("w"))
    c, w = F.col("cell"), F.col("w")
    return dirty.select(
        "c_custkey", cells.optional_int(c).alias("int_value"), cells.optional_int_reject(c).alias("int_reject"),
        cells.optional_int(c, strip_commas=False).alias("strict_int"), cells.optional_float(c).alias("float_value"),
        cells.optional_float_reject(c).alias("float_reject"), F.round(cells.unit_weight(w), 6).alias("weight"),
        cells.unit_weight_reject(w).alias("weight_reject"),
    )


@query("row_checks", """
WITH c AS (
  SELECT c_custkey, c_nationkey, c_acctbal < 0 AS r1, length(c_mktsegment) > 9 AS r2, c_custkey % 211 = 0 AS r3 FROM customer)
SELECT c_nationkey, count(*) AS rows, count(*) FILTER (WHERE r1 OR r2 OR r3) AS bad_rows,
  count(*) FILTER (WHERE r1) AS balance, count(*) FILTER (WHERE r2) AS segment, count(*) FILTER (WHERE r3) AS key,
  count(*) FILTER (WHERE r1 OR r2 OR r3) = 0 AS accepted FROM c GROUP BY ALL
""")
def row_checks(table, spark):
    checked = checks.with_rejects(table("customer"), {
        "balance": F.col("c_acctbal") >= 0, "segment": F.length("c_mktsegment") <= 9, "key": F.col("c_custkey") % 211 != 0,
    })
    status = checks.group_status(checked, ["c_nationkey"])
    names = checked.groupBy("c_nationkey").agg(*[
        F.count_if(F.array_contains("rejects", r)).alias(r) for r in ("balance", "segment", "key")
    ])
    return status.join(names, "c_nationkey")


@query("whole_groups", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000 AND o_orderstatus = 'F')
""")
def whole_groups(table, spark):
    checked = checks.with_rejects(
        table("orders"), {"price": ~((F.col("o_totalprice") > 480000) & (F.col("o_orderstatus") == "F"))}
    )
    return checks.whole_groups(checked, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("required_text", """
WITH d AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN '   ' ELSE ' ' || p_name || '  ' END AS cell FROM part)
SELECT p_partkey, CASE WHEN trim(cell) <> '' AND length(trim(cell)) <= 9 THEN trim(cell) END AS text,
  CASE WHEN cell IS NULL THEN 'missing' WHEN trim(cell) = '' THEN 'blank' WHEN length(trim(cell)) > 9 THEN 'too_long' END AS reject FROM d
""")
def required_text(table, spark):
    cell = (
        F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("string")).when(F.col("p_size") % 7 == 1, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")))
    )
    return table("part").select("p_partkey", cells.required_text(cell, 9).alias("text"), cells.required_text_reject(cell, 9).alias("reject"))


@query("identifier_norm", """
WITH p AS (SELECT p_partkey, trim(regexp_replace(lower(p_type || ' / ' || p_name || '--' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS name,
  trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '_') AS kind FROM part)
SELECT p_partkey, name, CASE kind WHEN 'small' THEN 'compact' WHEN 'large' THEN 'big' ELSE kind END AS kind FROM p
""")
def identifier_norm(table, spark):
    joined = F.concat(F.col("p_type"), F.lit(" / "), F.col("p_name"), F.lit("--"), F.col("p_brand"))
    return table("part").select(
        "p_partkey", labels.identifier(joined).alias("name"),
        labels.identifier(F.col("p_type"), {"small": "compact", "large": "big"}).alias("kind"),
    )


@query("service_dates", """
SELECT o_orderkey, strftime(CASE WHEN strftime(o_orderdate, '%m-%d') = '02-29' THEN NULL
  ELSE TRY_CAST('2023-' || strftime(o_orderdate, '%m-%d') AS DATE) END, '%Y-%m-%d') AS service_date,
  CASE WHEN strftime(o_orderdate, '%m-%d') = '02-29' THEN 'bad_date' END AS reject FROM orders
""")
def service_dates(table, spark):
    day = F.col("o_orderdate")
    shapes = [F.date_format(day, p) for p in ("d-MMM", "MMMM d", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy")]
    cell = pick(F.col("o_orderkey") % 4, *shapes)
    return table("orders").select(
        "o_orderkey", F.date_format(labels.service_date(cell, F.lit(2023)), "yyyy-MM-dd").alias("service_date"),
        labels.service_date_reject(cell, F.lit(2023)).alias("reject"),
    )


@query("header_forward_fill", """
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type IN ('signup', 'error') THEN event_type END AS mark FROM events)
SELECT event_id, last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS mark FROM e
""")
def header_forward_fill(table, spark):
    blanked = table("events").select(
        "user_id", "event_id", F.when(F.col("event_type").isin("signup", "error"), F.col("event_type")).otherwise("  ").alias("mark")
    )
    return reshape.forward_fill_blank(blanked, ["user_id"], "event_id", ["mark"]).select("event_id", "mark")


@query("schema_union", """
SELECT 's' || s_suppkey AS id, s_name AS name, '' AS segment, CAST(s_nationkey AS VARCHAR) AS nation, '' AS event_date FROM supplier
UNION ALL
SELECT 'c' || c_custkey, c_name, c_mktsegment, '', '' FROM customer
""")
def schema_union(table, spark):
    suppliers = table("supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    customers = table("customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return reshape.union_filled([suppliers, customers], ["id", "name", "segment", "nation", "event_date"], F.lit(""))


@query("acronym", """
SELECT p_partkey, CASE lower(p_name) WHEN 'red bolt' THEN 'RB_1' ELSE
  array_to_string(list_transform(list_filter(string_split(p_name || ' ' || p_brand || ' 9x', ' '), lambda w: regexp_matches(w, '^[A-Za-z]')),
  lambda w: upper(w[1])), '') END AS acronym FROM part
""")
def acronym(table, spark):
    known = labels.lookup(F.lower("p_name"), {"red bolt": "RB_1"})
    whole = F.concat_ws(" ", "p_name", "p_brand", F.lit("9x"))
    return table("part").select("p_partkey", F.coalesce(known, labels.acronym(whole)).alias("acronym"))


@query("global_sequence", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_partkey, l_suppkey, l_extendedprice,
  'CAP-' || printf('%04d', row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax)) AS id
FROM lineitem
""")
def global_sequence(table, spark):
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    numbered = ids.number_rows(table("lineitem").select(*keys), keys, "n")
    return numbered.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), "l_partkey", "l_suppkey", "l_extendedprice",
        ids.padded_id(F.lit("CAP"), F.col("n")).alias("id"),
    )


@query("next_id", """
WITH k AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'external_acad_' || printf('%04d', c_custkey)
  WHEN 1 THEN 'external_acad_cal_' || printf('%04d', c_custkey * 11) ELSE 'external_lgu_' || (c_custkey * 2) END AS id FROM customer)
SELECT 'external_acad' AS base, coalesce(max(TRY_CAST(regexp_extract(id, '^external_acad_(\\d+)$', 1) AS BIGINT)), 0) + 1 AS next_number,
  'external_acad_' || printf('%04d', coalesce(max(TRY_CAST(regexp_extract(id, '^external_acad_(\\d+)$', 1) AS BIGINT)), 0) + 1) AS next_id FROM k
""")
def next_id(table, spark):
    key = F.col("c_custkey")
    made = (
        F.when(key % 3 == 0, F.concat(F.lit("external_acad_"), F.format_string("%04d", key)))
        .when(key % 3 == 1, F.concat(F.lit("external_acad_cal_"), F.format_string("%04d", key * 11)))
        .otherwise(F.concat(F.lit("external_lgu_"), key * 2))
    )
    out = ids.next_number(table("customer").select(made.alias("id")), "id", "external_acad")
    return out.select(F.lit("external_acad").alias("base"), "next_number", "next_id")
