"""Streaming runs end where batch runs end."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from railtide.operators import dedupe
from railtide.sinks import tables
from railtide.streaming import events as streams

SCHEMA = "ord bigint, a string, b string, ts timestamp"


def at(minute):
    return dt.datetime(2026, 6, 18, 10, 0) + dt.timedelta(minutes=minute)


def feed(spark, tmp_path, *batches):
    folder = tmp_path / "in"
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / f"b{number}"))
    return streams.read_stream(spark, str(folder / "*"), SCHEMA, files_per_batch=1)


ROWS = [
    [(1, "x", "p", at(0)), (2, "x", "q", at(1)), (3, "y", "p", at(2))],
    [(4, "z", "q", at(3)), (5, "w", None, at(4)), (6, None, None, at(5))],
    [(7, "z", "r", at(6)), (8, "w", "s", at(7))],
]


def test_dedupe_stream_equals_batch(spark, tmp_path):
    stream = feed(spark, tmp_path, *ROWS)
    path = str(tmp_path / "t")
    streams.dedupe_stream(stream, ["a", "b"], "ord", path, str(tmp_path / "c"))
    everything = spark.createDataFrame([r for b in ROWS for r in b], SCHEMA)
    expected = sorted(r.ord for r in dedupe.greedy_dedupe(everything, "ord", ["a", "b"]).collect())
    got = sorted(r.ord for r in tables.read_table(spark, path).collect())
    assert got == expected == [1, 4, 5, 6]
    # nothing new: the run stops at once; a replay from scratch finds its keys stored
    streams.dedupe_stream(stream, ["a", "b"], "ord", path, str(tmp_path / "c"))
    streams.dedupe_stream(stream, ["a", "b"], "ord", path, str(tmp_path / "c2"))
    assert tables.read_table(spark, path).count() == 4


def test_snapshot_and_absent_streams(spark, tmp_path):
    stream = feed(spark, tmp_path, *ROWS)
    streams.snapshot_stream(stream.where("a is not null"), ["a"], ["ts", "ord"], str(tmp_path / "s"), str(tmp_path / "c1"))
    assert {r.a: r.ord for r in streams.read_snapshot(spark, str(tmp_path / "s"), ["a"], ["ts", "ord"]).collect()} == {"x": 2, "y": 3, "z": 7, "w": 8}
    streams.absent_stream(stream.where("a is not null"), ["a"], str(tmp_path / "n"), str(tmp_path / "c3"))
    assert sorted(r.a for r in tables.read_table(spark, str(tmp_path / "n")).collect()) == ["w", "x", "y", "z"]


def run_to_memory(stream, name, mode, checkpoint):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def test_single_key_dedupe_and_late_rule(spark, tmp_path):
    stream = feed(spark, tmp_path, *ROWS)
    timed, unknown = streams.split_unknown_times(stream, "ts")
    assert unknown.isStreaming
    first = run_to_memory(streams.first_within(timed.where("a is not null"), ["a"], "ts", "1 hour"), "first", "append", str(tmp_path / "c"))
    assert first.count() == 4
    now = F.lit("2026-06-19 10:04:30").cast("timestamp")
    young = run_to_memory(streams.young_only(stream, "ts", now, 1.0), "young", "append", str(tmp_path / "c2"))
    assert sorted(r.ord for r in young.collect()) == [6, 7, 8]


def test_sweep_counts(spark, tmp_path):
    stream = feed(spark, tmp_path, *ROWS)
    counted = run_to_memory(streams.sweep_counts(stream, "ts", "24 hours", "8 hours", ["a"]), "sweeps", "complete", str(tmp_path / "c"))
    assert counted.where("a = 'x'").count() == 3 and counted.where("a = 'x'").agg(F.sum("n")).first()[0] == 6


def test_staleness_alerts(spark, tmp_path):
    stream = feed(
        spark, tmp_path, [(1, "A", None, at(0)), (2, "B", None, at(0))], [(3, "B", None, at(40))], [(4, "C", None, at(80))], [(5, "C", None, at(81))])
    alerts = run_to_memory(streams.staleness_alerts(stream, "a", "ts", 45.0, "0 seconds"), "alerts", "append", str(tmp_path / "c"))
    assert [(r.a, r.last_seen) for r in alerts.collect()] == [("A", at(0))]


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_of_parts_is_read_as_a_stream(spark, tmp_path, parts):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    folder = str(tmp_path / "events.parquet")
    table.repartition(parts).write.parquet(folder)
    stored = spark.read.parquet(folder)
    stream = streams.table_stream(stored, stored.schema)
    streams.snapshot_stream(stream.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], str(tmp_path / "t"), str(tmp_path / "p"))
    current = streams.read_snapshot(spark, str(tmp_path / "t"), ["user_id"], ["ts", "event_id"])
    assert current.count() == table.select("user_id").distinct().count()


def test_first_rows_of_any_batch(spark, tmp_path):
    rows = [ROWS[0], [(9, "x", "p", at(3)), (10, None, "q", at(4)), (4, "z", "q", at(3))], [(2, "x", "q", at(1)), (11, None, "q", at(9)), (3, "z", "a", at(6))]]
    stream = feed(spark, tmp_path, *rows)
    path = str(tmp_path / "t")
    streams.first_row_stream(stream, ["a"], "ord", path, str(tmp_path / "c"))
    assert sorted((r.ord, r.a, r.b, r.ts) for r in streams.read_batches(spark, path).collect()) == [
        (1, "x", "p", at(0)), (3, "y", "p", at(2)), (4, "z", "q", at(3)), (10, None, "q", at(4))]
    streams.first_row_stream(stream, ["a"], "ord", path, str(tmp_path / "c"))
    assert streams.read_batches(spark, path).count() == 4


def keyed(first, n):
    return [(i, f"k{i}", None, at(0)) for i in range(first, first + n)]


@pytest.mark.parametrize("run", ["first", "snapshot"])
def test_a_batch_does_not_pay_for_what_is_stored(spark, tmp_path, run):
    """The same small batch after a small and after a large one reads, updates and writes the same."""
    seen = []
    for name, stored in (("small", 50), ("large", 20_000)):
        folder = tmp_path / name
        stream = feed(spark, folder, keyed(0, stored), [(stored + 1, "k7", None, at(1)), *keyed(10 ** 6, 20)])
        path, progress = str(folder / "t"), str(folder / "c")
        if run == "first":
            query = streams.first_row_stream(stream, ["a"], "ord", path, progress)
        else:
            query = streams.snapshot_stream(stream, ["a"], ["ts", "ord"], path, progress)
        last = next(p for p in query.recentProgress if p["batchId"] == 1)
        state = last["stateOperators"][0]
        assert state["numRowsTotal"] >= stored and "rocksdbTotalBytesRead" in str(state["customMetrics"])
        written = spark.read.parquet(f"{path}/batch=1").count()
        seen.append((last["numInputRows"], state["numRowsUpdated"], written))
        assert state["customMetrics"]["rocksdbTotalBytesRead"] < 20_000
    assert seen[0] == seen[1] and seen[0][:2] == (21, 21)


def test_late_untimed_and_repeated_rows_in_one_sink(spark, tmp_path):
    rows = [
        [(1, "a", None, at(0)), (2, "b", None, None), (1, "a", None, at(0)), (3, "c", None, at(300))],
        [(6, "f", None, at(301))],
        [(1, "a", None, at(0)), (2, "b", None, None), (3, "c", None, at(300)), (4, "d", None, at(239)), (5, "e", None, at(241))],
    ]
    kept = streams.first_within_or_untimed(feed(spark, tmp_path, *rows), ["ord"], "ts", "1 hour")
    streams.run_available(kept, streams.write_batch(str(tmp_path / "t")), str(tmp_path / "c"))
    assert sorted(r.ord for r in streams.read_batches(spark, str(tmp_path / "t")).collect()) == [1, 2, 2, 3, 5, 6]


def test_keys_that_nobody_counts_are_looked_up_once(spark, tmp_path):
    rows = [[(i % 900, "a", None, at(0)) for i in range(1000)], [(i, "a", None, at(1)) for i in range(800, 1000)]]
    looked = {}
    for counted in (True, False):
        folder = tmp_path / str(counted)
        kept = streams.first_within(feed(spark, folder, *rows), ["ord"], "ts", "1 hour")
        query = streams.run_available(kept, streams.write_batch(str(folder / "t")), str(folder / "c"), counted=counted)
        assert sorted(r.ord for r in streams.read_batches(spark, str(folder / "t")).collect()) == list(range(1000))
        first = next(p for p in query.recentProgress if p["batchId"] == 0)
        looked[counted] = first["stateOperators"][0]["customMetrics"]["rocksdbGetCount"]
    assert looked[False] < looked[True]


def test_stops_inside_a_batch_and_across(spark, tmp_path):
    rows = [
        [(1, "A", None, at(0)), (2, "A", None, at(50)), (3, "A", None, at(60)), (4, "B", None, at(0)), (5, "B", None, None)],
        [(6, "A", None, at(110)), (7, "B", None, at(20)), (8, "C", None, at(100))],
        [(9, "A", None, at(111)), (10, "D", None, at(200))],
    ]
    alerts = streams.staleness_alerts(feed(spark, tmp_path, *rows), "a", "ts", 45.0, "0 seconds")
    streams.run_available(alerts, streams.write_batch(str(tmp_path / "t")), str(tmp_path / "c"))
    got = sorted((r.a, r.last_seen) for r in streams.read_batches(spark, str(tmp_path / "t")).collect())
    assert ("A", at(0)) in got and ("A", at(60)) in got and ("A", at(111)) in got and ("C", at(100)) in got
    assert len([g for g in got if g[0] == "A"]) == 3 and not [g for g in got if g[0] == "D"]
