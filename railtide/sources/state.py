"""What earlier runs left behind: dedupe keys of stored events and ledgers of processed URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railtide.functions import text, urls


def event_key(source: Column, name: Column, date: Column) -> Column:
    """(source, event, date) folded into one key; NULL unless source and event are named."""
    parts = [F.lower(F.btrim(F.coalesce(c, F.lit("")))) for c in (source, name, date)]
    return F.when((parts[0] != "") & (parts[1] != "") & (parts[1] != "n/a"), F.to_json(F.struct(*[
        p.alias(n) for p, n in zip(parts, ("s", "e", "d"))
    ])))


def key_columns(keep_params=None) -> list[Column]:
    """The three dedupe keys of events."""
    key = urls.url_key(F.col("source_url")) if keep_params is None else urls.url_key(F.col("source_url"), keep_params)
    return [
        key.alias("url_key"), text.text_key(F.col("post_text"), F.col("image_text")).alias("text_key"),
        event_key(F.col("source_name"), F.col("event_name"), F.col("event_date")).alias("event_key"),
    ]


def stored_keys(events: DataFrame, keep_params=None) -> DataFrame:
    """The three dedupe keys of stored events; the scan reads just the six columns they need."""
    return events.select(*key_columns(keep_params))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """URLs processed so far; an absent ledger is an empty one."""
    empty = spark.createDataFrame([], "url string")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema("url string").parquet(path) if system.exists(folder) else empty
