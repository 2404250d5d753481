"""Parquet tables that are replaced as a whole, appended to, or replaced by partition."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import labels
from railtide.operators import checks, merge, reshape
from railtide.session import cut_lineage

POINTER = "CURRENT"
VERSION = re.compile(r"^v(\d{6,})$")


def _system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _child(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path, name)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version the pointer names, None when nothing was written yet."""
    system, _ = _system(spark, path)
    pointer = _child(spark, path, POINTER)
    if not system.exists(pointer):
        return None
    name = spark.read.text(f"{path}/{POINTER}").first()[0]
    return f"{path}/{name}"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of a table: of its current version, or of all its partitions; None when nothing was written yet."""
    version = current_version(spark, path)
    system, folder = _system(spark, path)
    if version is None and not system.exists(folder):
        return None
    return spark.read.option("mergeSchema", True).parquet(version or path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write the next version beside the current one, then move the pointer.

    Readers see the old rows or the new ones, never a mix, and a table can be rewritten from itself.
    """
    spark = df.sparkSession
    system, folder = _system(spark, path)
    used = [0]
    if system.exists(folder):
        for status in system.listStatus(folder):
            match = VERSION.match(status.getPath().getName())
            if match:
                used.append(int(match.group(1)))
    name = f"v{max(used) + 1:06d}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{name}")
    fresh = _child(spark, path, f"{POINTER}.next")
    stream = system.create(fresh, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    target = _child(spark, path, POINTER)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(fresh, target, options)
    return f"{path}/{name}"


def append_rows(df: DataFrame, path: str) -> str:
    """Append to the current version (or start the table)."""
    version = current_version(df.sparkSession, path)
    if version is None:
        return replace_table(df, path)
    df.write.mode("append").parquet(version)
    return version


def load_absent(new: DataFrame, path: str, key: Sequence[str]) -> DataFrame:
    """Append the rows whose key is not stored; returns them."""
    stored = read_table(new.sparkSession, path)
    fresh = cut_lineage(new if stored is None else merge.insert_if_absent(stored, new, key))
    append_rows(fresh, path)
    return fresh


def load_upsert(new: DataFrame, path: str, key: Sequence[str]) -> DataFrame:
    stored = read_table(new.sparkSession, path)
    replace_table(new if stored is None else merge.upsert(stored, new, key), path)
    return read_table(new.sparkSession, path)


def load_update_only(new: DataFrame, path: str, key: Sequence[str]) -> DataFrame:
    """Update stored rows; returns the matched and unmatched counts (one row)."""
    stored = read_table(new.sparkSession, path)
    if stored is None:
        raise ValueError(f"{path} holds no table to update")
    new = cut_lineage(new)
    report = cut_lineage(merge.update_report(stored, new, key))
    replace_table(merge.update_only(stored, new, key).drop("was_updated"), path)
    return report


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace just the partitions that ``df`` holds rows for; rows of other partitions stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_twice(df: DataFrame, main: str, backup: str, partition_by: Sequence[str]) -> None:
    """The same partitions of a table and its backup replaced; rows are computed once."""
    rows = cut_lineage(df)
    replace_partitions(rows, main, partition_by)
    replace_partitions(rows, backup, partition_by)


def write_accepted_groups(df: DataFrame, path: str, group: str, rejects: str = "rejects") -> DataFrame:
    """Write the groups without bad rows, leave the others as they are; returns the status per group."""
    rows = cut_lineage(df)
    status = cut_lineage(checks.group_status(rows, [group], rejects))
    replace_partitions(checks.whole_groups(rows, [group], rejects), path, [group])
    return status


def export_calendars(rows: DataFrame, path: str, columns: Sequence[str] = tuple(vocab.CALENDAR_COLUMNS)) -> None:
    """Append fixed columns to one CSV folder per school; missing columns are empty."""
    named = rows.withColumn("acronym", labels.acronym(F.col("source_name")))
    fixed = reshape.union_filled([named], [*columns, "acronym"], F.lit(""))
    fixed.write.mode("append").partitionBy("acronym").csv(path, header=True, emptyValue="")


def append_ledger(urls: DataFrame, path: str) -> None:
    """Add the distinct URLs to a ledger folder."""
    urls.select("url").where("url is not null").distinct().write.mode("append").parquet(path)


def to_database(df: DataFrame, url: str, table: str, batch_rows: int = 500, **properties: str) -> None:
    """Append to a JDBC table."""
    df.write.option("batchsize", batch_rows).jdbc(url, table, mode="append", properties=properties)
