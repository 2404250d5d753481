"""Incremental runs as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from railtide.functions import times
from railtide.operators import dedupe, gapfill, merge
from railtide.session import cut_lineage
from railtide.sinks import tables


def read_stream(spark: SparkSession, folder: str, schema, source: str = "parquet", pattern: str | None = None,
                files_per_batch: int | None = None, archive: str | None = None) -> DataFrame:
    """File stream; finished files may be moved to an archive folder."""
    reader = spark.readStream.format(source).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def table_stream(table: DataFrame, schema) -> DataFrame:
    """The files of a parquet table as a stream, be the table one file or a folder of parts."""
    files = table.inputFiles()
    folder, _, name = files[0].rpartition("/")
    return read_stream(table.sparkSession, folder, schema, pattern=name if len(files) == 1 else None)


# keyed state on disk, of which a batch reads and writes the keys that it holds
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# counting keys looks each one up again before it is written or removed
COUNTED_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


@contextmanager
def keyed_state(spark: SparkSession, counted: bool = True):
    """Streams that start inside keep their state in RocksDB and checkpoint changes only."""
    settings = KEYED_STATE | {COUNTED_STATE: str(counted).lower()}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
                  counted: bool = True) -> StreamingQuery:
    """Process what is there and stop.  Unless ``counted``, progress reports no number of stored keys, which costs less."""
    with keyed_state(stream.sparkSession, counted):
        query = (
            stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A step that writes each batch to a folder of its own; a batch that is replayed replaces its rows."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return step


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``write_batch`` has written below ``path``."""
    return spark.read.parquet(path).drop("batch")


def dedupe_stream(stream: DataFrame, keys: Sequence[str], order: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows that no stored row and no earlier kept row shares a key with.

    ``order`` identifies a row: a batch that is replayed after a failure finds its own rows stored
    and adds nothing.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage(batch)
        stored = tables.read_table(rows.sparkSession, path)
        if stored is not None:
            rows = merge.insert_if_absent(stored, rows, [order])
        held = [] if stored is None else [(k, stored) for k in keys]
        fresh = cut_lineage(dedupe.greedy_dedupe(rows, order, keys, held))
        tables.append_rows(fresh, path)

    return run_available(stream, step, checkpoint)


def snapshot_stream(stream: DataFrame, key: Sequence[str], order: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest row per key: each batch appends the rows of the keys that it holds.

    What is latest is keyed state; a batch reads and writes its own keys there and nothing of what
    was stored before, so its cost follows the batch.  ``path`` belongs to ``checkpoint``;
    ``read_snapshot`` gives the current rows.
    """
    newest = gapfill.latest_per_key(stream, key, order)
    return run_available(newest, write_batch(path), checkpoint, "update")


def read_snapshot(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key that ``snapshot_stream`` has written."""
    return gapfill.latest_per_key(read_batches(spark, path), key, order)


def first_rows(stream: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The first row of each key: of the first batch that holds the key, the row of the smallest ``order``.

    Update mode.  Keys are combined before the shuffle.  The state of a key is its first row with
    the time of that row's batch; only rows of the batch at hand leave, so every key leaves once.
    NULL is a key like any other.
    """
    rest = [c for c in stream.columns if c not in key]
    firsts = stream.withColumn("_now", F.current_timestamp()).groupBy(*key).agg(
        F.min_by(F.struct(*rest), F.struct("_now", order)).alias("_row"), F.min("_now").alias("_seen")
    )
    return firsts.where(F.col("_seen") == F.current_timestamp()).select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in stream.columns]
    )


def first_row_stream(stream: DataFrame, key: Sequence[str], order: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append the first row of each key (see ``first_rows``); cost follows the batch.

    A replayed batch replaces its own rows.  ``path`` belongs to ``checkpoint``; ``read_batches``
    gives the rows.
    """
    return run_available(first_rows(stream, key, order), write_batch(path), checkpoint, "update")


def absent_stream(stream: DataFrame, key: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Append rows whose key is new; within a batch the first seen row of a key counts."""
    def step(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(list(key))
        stored = tables.read_table(batch.sparkSession, path)
        tables.append_rows(cut_lineage(fresh if stored is None else merge.insert_if_absent(stored, fresh, key)), path)

    return run_available(stream, step, checkpoint)


def first_within(stream: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """One row per key while its watermark lasts; rows of unknown time are the caller's to route."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))


def split_unknown_times(stream: DataFrame, at: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a time, rows without): a watermark would drop the latter, which are to be kept."""
    return stream.where(F.col(at).isNotNull()), stream.where(F.col(at).isNull())


def first_within_or_untimed(stream: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """Timed rows once per key and not later than the watermark; rows of unknown time all, around it.

    Both leave as one stream, in append mode.
    """
    timed, untimed = split_unknown_times(stream, at)
    return first_within(timed, key, at, delay).unionByName(untimed)


def young_only(stream: DataFrame, at: str, now: Column, max_days: float) -> DataFrame:
    """Late-data rule: too old goes, unknown age stays."""
    return stream.where(times.within_age(times.age_days(now, F.col(at)), max_days))


def sweep_counts(stream: DataFrame, at: str, length: str, step: str, by: Sequence[str], delay: str | None = None) -> DataFrame:
    """Rows per overlapping look-back window."""
    timed = stream.withWatermark(at, delay) if delay else stream
    return timed.groupBy(F.window(at, length, step), *by).agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n")


def staleness_alerts(stream: DataFrame, key: str, at: str, minutes: float, delay: str) -> DataFrame:
    """One row per key whenever its reports stop for longer than ``minutes`` of event time.

    The state of a key is the time of its newest report; a new report moves the timer.  A stop shows
    when the watermark passes the timer, or when the next report comes later than that.  Reports
    older than the newest one change nothing.
    """
    limit = int(minutes * 60_000_000)

    def watch(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (seen,) = state.get
            state.remove()
            yield pd.DataFrame({key: [name[0]], "last_seen": [pd.Timestamp(seen, unit="us")]})
            return
        times_in = np.sort(np.concatenate([b["_at"].to_numpy(dtype="int64") for b in batches]))
        if state.exists:
            times_in = np.append(state.get[0], times_in[times_in > state.get[0]])
        stopped = times_in[:-1][np.diff(times_in) > limit]
        if len(stopped):
            yield pd.DataFrame({key: name[0], "last_seen": pd.to_datetime(stopped, unit="us")})
        newest = int(times_in[-1])
        state.update((newest,))
        # a timer must lie past the watermark; a report that is late already is due at once
        state.setTimeoutTimestamp(max((newest + limit) // 1000, state.getCurrentWatermarkMs() + 1))

    # a report of unknown time says nothing about when reports stopped
    timed = stream.where(F.col(at).isNotNull()).withWatermark(at, delay).withColumn("_at", F.unix_micros(at))
    return timed.select(key, "_at", at).groupBy(key).applyInPandasWithState(
        watch, f"{key} {stream.schema[key].dataType.simpleString()}, last_seen timestamp", "newest bigint", "append", GroupStateTimeout.EventTimeTimeout)
