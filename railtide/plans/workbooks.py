"""Reference workbooks: typed rows with reject reasons, ids in sheet order, insert if absent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import cells
from railtide.operators import checks, ids, reshape
from railtide.session import cut_lineage
from railtide.sinks import tables
from railtide.sources import files


class RejectedFile(ValueError):
    """A sheet that holds bad rows, in strict mode."""


def _text_columns(spec: Mapping[str, tuple[str, int]]) -> tuple[dict[str, Column], dict[str, Column]]:
    values = {out: cells.required_text(F.col(f"`{name}`"), n) for name, (out, n) in spec.items()}
    rejects = {out: cells.required_text_reject(F.col(f"`{name}`"), n) for name, (out, n) in spec.items()}
    return values, rejects


def _typed(sheet: DataFrame, values: Mapping[str, Column], rejects: Mapping[str, Column], keep: list[str]) -> DataFrame:
    reasons = F.array_compact(F.array(*[
        F.when(r.isNotNull(), F.concat(F.lit(name + ": "), r)) for name, r in rejects.items()
    ]))
    return sheet.select(*keep, *[v.alias(n) for n, v in values.items()], reasons.alias("rejects"))


def accept(typed: DataFrame, strict: bool) -> DataFrame:
    """Good rows; in strict mode one bad row rejects everything."""
    if strict and not checks.quarantined(typed).isEmpty():
        raise RejectedFile("the sheet holds bad rows")
    good = checks.accepted(typed)
    if good.isEmpty():
        raise RejectedFile("the sheet holds no rows")
    return good


def capacity(sheet: DataFrame) -> DataFrame:
    values, rejects = _text_columns(vocab.CAPACITY_TEXT)
    for name, out in vocab.CAPACITY_AREA.items():
        values[out], rejects[out] = cells.optional_float(F.col(name)), cells.optional_float_reject(F.col(name))
    for name, out in vocab.CAPACITY_COUNTS.items():
        values[out] = cells.optional_int(F.col(name), strip_commas=False).cast("int")
        rejects[out] = cells.optional_int_reject(F.col(name), strip_commas=False)
    return _typed(sheet, values, rejects, ["file", "row_idx"])


def incidents(sheet: DataFrame) -> DataFrame:
    return _typed(sheet, *_text_columns(vocab.INCIDENT_TEXT), ["file", "row_idx"])


def protocols(sheet: DataFrame) -> DataFrame:
    return _typed(sheet, *_text_columns(vocab.PROTOCOL_TEXT), ["file", "row_idx"])


def friction(sheet: DataFrame, domain: str = "friction_domain") -> DataFrame:
    values, rejects = _text_columns(vocab.FRICTION_TEXT)
    for name, out in vocab.FRICTION_WEIGHT.items():
        values[out], rejects[out] = cells.unit_weight(F.col(f"`{name}`")), cells.unit_weight_reject(F.col(f"`{name}`"))
    return _typed(sheet, values, rejects, [domain, "file", "row_idx"])


def students(sheet: DataFrame) -> DataFrame:
    """Month x year counts; the first column names the month."""
    plain = [c for c in sheet.columns if c not in ("file", "row_idx")]
    long = reshape.month_matrix(sheet, plain[0], plain[1:])
    bad = F.when(F.col("reject_reason").isNotNull(), F.concat(F.lit("value: "), F.col("reject_reason")))
    early = F.when(F.col("year") < 2000, F.lit("year: out_of_range"))
    return long.withColumn("rejects", F.array_compact(F.array(bad, early)))


def numbered(good: DataFrame, prefix: str, group: str | None = None) -> DataFrame:
    """Ids in sheet order; per group the group's name joins the prefix."""
    if group is None:
        out = ids.number_rows(good, ["file", "row_idx"], "_n")
        made = ids.padded_id(F.lit(prefix), F.col("_n"))
    else:
        out = ids.number_within(good, [group], ["file", "row_idx"], "_n")
        made = ids.padded_id(F.concat_ws("-", F.lit(prefix), F.upper(group)), F.col("_n"))
    rest = [c for c in good.columns if c not in ("file", "row_idx")]
    return out.select(made.alias("id"), *rest)


KINDS = {"capacity": (capacity, "CAP"), "incidents": (incidents, "PSOR"), "protocols": (protocols, "APTA")}
REQUIRED = {
    "capacity": [*vocab.CAPACITY_TEXT, *vocab.CAPACITY_AREA, *vocab.CAPACITY_COUNTS],
    "incidents": list(vocab.INCIDENT_TEXT), "protocols": list(vocab.PROTOCOL_TEXT),
    "friction": [*vocab.FRICTION_TEXT, *vocab.FRICTION_WEIGHT],
}


def read_workbook(spark: SparkSession, kind: str, path, strict: bool = True) -> DataFrame:
    """Numbered rows of one workbook; ``path`` maps domains to files for ``friction``."""
    if kind == "friction":
        sheet = files.read_tagged(spark, path, "friction_domain", REQUIRED[kind])
        return numbered(accept(friction(sheet), strict), "FRI", "friction_domain")
    if kind == "students":
        good = accept(students(files.read_sheet(spark, path)), strict)
        return reshape.number_months(good).select(
            "id", "year", "month_number", "month_name", "is_total", F.col("value").cast("int").alias("student_transactions"))
    typed, prefix = KINDS[kind]
    return numbered(accept(typed(files.read_sheet(spark, path, REQUIRED[kind])), strict), prefix)


def load_workbook(spark: SparkSession, kind: str, path, table: str, now: Column, strict: bool = True) -> DataFrame:
    """Insert the rows whose id is not stored yet; returns them."""
    new = cut_lineage(read_workbook(spark, kind, path, strict).withColumn("load_timestamp", now))
    return tables.load_absent(new, table, ["id"])
