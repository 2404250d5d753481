"""Files as DataFrames: discovery, choice of a pending file, headerless and headered sheets."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import labels
from railtide.session import cut_lineage

SHEET_SUFFIX = r"(?i)\.(csv|xlsx)$"


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Every file below ``folder``: path, name, stem, depth.  Contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(folder).select("path")
    )
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return listed.select(
        "path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"),
        F.size(F.split(F.col("path"), "/")).alias("depth"),
    )


def with_file_period(files: DataFrame, token: str = "afcs") -> DataFrame:
    """Keep sheets named for a month: no temporary files, the token and a month with year in the stem."""
    return (
        files.where(
            F.col("name").rlike(SHEET_SUFFIX) & ~F.col("name").startswith("~$")
            & F.lower("stem").contains(token)
        )
        .withColumns({"year": labels.file_year(F.col("stem")), "month": labels.file_month(F.col("stem"))})
        .where("year is not null and month is not null")
    )


def discover_sheets(spark: SparkSession, folder: str, token: str = "afcs") -> DataFrame:
    return with_file_period(list_files(spark, folder), token).orderBy("year", "month", F.lower("name"))


def pending_file(files: DataFrame, name: str, preferred_folder: str) -> DataFrame:
    """The one file of that name (any case) to load: preferred folder, then shallowest, then by path."""
    preferred = F.lower("path").contains(preferred_folder.lower())
    return (
        files.where((F.lower("name") == name.lower()) & ~F.col("name").startswith("~$"))
        .orderBy(F.when(preferred, 0).otherwise(1), "depth", F.lower("path")).limit(1)
    )


def with_row_index(scan: DataFrame) -> DataFrame:
    """Add ``file`` and ``row_idx`` (0-based place in the file) to a scan of line-based files.

    Large files stay split: a row's place is its place in its split plus the rows of the splits
    before it, so only one small row per split meets in a window.
    """
    tagged = scan.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mono"),
    )
    before = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = tagged.groupBy(F.col("file").alias("_f"), F.col("_block").alias("_b")).agg(
        F.min("_mono").alias("_first"), F.count("*").alias("_n")
    ).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    met = tagged.join(splits, (F.col("file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return met.withColumn("row_idx", F.col("_base") + F.col("_mono") - F.col("_first")).drop(
        "_block", "_mono", "_f", "_b", "_first", "_n", "_base"
    )


# a cell of a CSV line that ends in it, and one whose quotes stay open; nothing here is tried twice
CLOSED_CELL = r'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|)'
OPEN_CELL = r'"(?:[^"]|"")*+'
# lines after which quotes are open: when they were closed before, and when they were open
OPENS = rf'^(?:{CLOSED_CELL},)*+{OPEN_CELL}\z'
STAYS_OPEN = rf'^(?:[^"]|"")*+\z|^(?:[^"]|"")*+"[^,]*+,(?:{CLOSED_CELL},)*+{OPEN_CELL}\z'


def _open_before(df: DataFrame, order: WindowSpec, outside: str, inside: str) -> DataFrame:
    """Whether quotes are open before each row of a window, if they are closed (_o0) or open (_o1) at its start.

    A row leads to ``outside`` if quotes were closed before it and to ``inside`` if they were open.
    Rows that lead to the same either way settle the state; between them only those that swap it count.
    """
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = (F.col(outside) == 1) & (F.col(inside) == 0)
    df = df.withColumn("_f", F.coalesce(F.sum(swaps.cast("int")).over(before), F.lit(0)) % 2)
    settled = F.when(F.col(outside) == F.col(inside), (F.col(outside) + F.col("_f")) % 2)
    df = df.withColumn("_e", settled).withColumn("_e", F.last("_e", ignorenulls=True).over(before))
    return df.withColumns({f"_o{s}": (F.coalesce("_e", F.lit(s)) + F.col("_f")) % 2 for s in (0, 1)}).drop("_e", "_f")


def read_records(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.[cC][sS][vV]") -> DataFrame:
    """CSV files as (file, row_idx, value): a record keeps the line breaks that its quotes hold.

    Large files stay split.  Whether a line begins inside quotes depends on all lines before it, so
    every line and then every split is read as a step from "quotes closed or open before" to "after";
    steps are combined inside splits, one row per split then says how it began.  Records that
    span lines or splits are put together by their number.  A quote that is never closed
    takes the rest of its file into one record, as CSV has it.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    value = F.regexp_replace("value", "\r$", "")
    quoted = value.contains('"')
    tagged = lines.select(
        value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mono"),
        F.when(quoted, value.rlike(OPENS).cast("int")).otherwise(0).alias("_a0"),
        F.when(quoted, value.rlike(STAYS_OPEN).cast("int")).otherwise(1).alias("_a1"),
    )
    order = Window.partitionBy("file", "_block").orderBy("_mono")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = _open_before(tagged, order, "_a0", "_a1")
    # for either state at the split's start: records begun so far, and the state after the line
    steps = steps.withColumns({
        **{f"_n{s}": F.sum(1 - F.col(f"_o{s}")).over(upto) for s in (0, 1)},
        **{f"_z{s}": F.when(F.col(f"_o{s}") == 1, F.col("_a1")).otherwise(F.col("_a0")) for s in (0, 1)},
    })
    steps = cut_lineage(steps.drop("_a0", "_a1"))
    last = F.max_by(F.struct("_n0", "_n1", "_z0", "_z1"), "_mono").alias("_end")
    splits = steps.groupBy(F.col("file").alias("_f_file"), F.col("_block").alias("_f_block")).agg(last).select("_f_file", "_f_block", "_end.*")
    by_split = Window.partitionBy("_f_file").orderBy("_f_block")
    began = _open_before(splits, by_split, "_z0", "_z1").withColumn("_start", F.col("_o0"))
    held = F.when(F.col("_start") == 1, F.col("_n1")).otherwise(F.col("_n0"))
    began = began.withColumn("_base", F.coalesce(F.sum(held).over(by_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = steps.join(
        began.select("_f_file", "_f_block", "_start", "_base"),
        (F.col("file") == F.col("_f_file")) & (F.col("_block") == F.col("_f_block")),
    )

    def under(name: str) -> Column:
        return F.when(F.col("_start") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    placed = met.select(
        "file", (F.col("_base") + under("_n") - 1).alias("row_idx"), "value", "_block", "_mono",
        ((under("_o") == 0) & (under("_z") == 0)).alias("_whole"),
    )
    parts = F.array_sort(F.collect_list(F.struct("_block", "_mono", "value")))
    joined = placed.where(~F.col("_whole")).groupBy("file", "row_idx").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return placed.where("_whole").select("file", "row_idx", "value").unionByName(joined)


def csv_cells(record: Column) -> Column:
    """Cells of one CSV record, quotes resolved; blank cells are NULL."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r',("(?:[^"]|"")*+(?:"[^,]*+|\z)|[^,]*+)'), 1)

    def bare(cell: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, r'^"((?:[^"]|"")*+)', 1), F.lit('""'), F.lit('"'))
        return F.concat(inner, F.regexp_extract(cell, r'^"(?:[^"]|"")*+"([^,]*+)', 1))

    resolved = F.transform(found, lambda c: F.when(c.startswith('"'), bare(c)).otherwise(c))
    return F.transform(resolved, lambda c: F.when(F.btrim(c) != "", c))


def read_grid(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.[cC][sS][vV]") -> DataFrame:
    """Headerless CSV sheets as (file, row_idx, cells); quoted line breaks belong to their cell."""
    return read_records(spark, path, pattern).select("file", "row_idx", csv_cells(F.col("value")).alias("cells"))


def _workbook_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import io

    import openpyxl

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            sheet = openpyxl.load_workbook(io.BytesIO(content), read_only=True, data_only=True).worksheets[0]
            rows = [[None if v is None else str(v) for v in row] for row in sheet.iter_rows(values_only=True)]
            yield pd.DataFrame({"file": path, "row_idx": range(len(rows)), "cells": rows})


def _workbook_rows_or_problem(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(len(batch)):
            try:
                for rows in _workbook_rows(iter([batch.iloc[at : at + 1]])):
                    yield rows.assign(problem=None)
            except Exception as error:  # whatever is wrong with a book is a problem of its year, not of the run
                kind = "no_workbook_reader" if isinstance(error, ImportError) else "unreadable"
                yield pd.DataFrame({"file": batch["path"].iloc[at : at + 1], "row_idx": -1, "cells": None, "problem": kind})


def read_workbook_grid(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """First sheet of each workbook as (file, row_idx, cells); needs openpyxl on the executors.

    Unless ``strict``, a book that cannot be read is one row without cells whose ``problem`` says why.
    """
    books = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.[xX][lL][sS][xX]").load(path).select("path", "content")
    if not strict:
        return books.mapInPandas(
            _workbook_rows_or_problem, "file string, row_idx bigint, cells array<string>, problem string")
    try:
        import openpyxl  # noqa: F401
    except ImportError as missing:
        raise RuntimeError("reading .xlsx needs openpyxl; save the sheet as .csv instead") from missing
    return books.mapInPandas(_workbook_rows, "file string, row_idx bigint, cells array<string>")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"sheet lacks the columns {missing}")
    return df


def read_sheet(spark: SparkSession, path: str | Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """CSV with a header, every column text, empty rows dropped, plus file and row_idx.

    Doubled quotes and line breaks inside quotes belong to the cell; such books are read unsplit.
    """
    scan = spark.read.csv(path, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True,
                          ignoreTrailingWhiteSpace=True, quote='"', escape='"', multiLine=True)
    require_columns(scan, required)
    return with_row_index(scan).na.drop("all", subset=[f"`{c}`" for c in scan.columns])


def read_tagged(spark: SparkSession, paths: Mapping[str, str | None], tag: str,
                required: Sequence[str] = ()) -> DataFrame:
    """Union of sheets with the label each file stands for; labels without a file are skipped."""
    frames = [
        read_sheet(spark, path, required).withColumn(tag, F.lit(label)) for label, path in paths.items() if path
    ]
    if not frames:
        raise ValueError("none of the files is there")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def friction_paths(files: DataFrame, folder: str = "External", names: Mapping[str, str] = vocab.FRICTION_FILES,
                   suffix: str = ".csv") -> dict[str, str | None]:
    """Path per friction domain, None where the file is not pending."""
    found = {}
    for domain, stem in names.items():
        row = pending_file(files, stem + suffix, folder).first()
        found[domain] = row["path"] if row else None
    return found
