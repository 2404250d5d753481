"""Operators against brute force, on both the small and the large path."""

import random

import pytest
from pyspark.sql import functions as F

from railtide.operators import checks, dedupe, gapfill, ids, joins, match, merge, nested, reshape, scan, tagging, topk


def sequential_greedy(rows):
    held, kept = set(), []
    for order, *keys in sorted(rows):
        mine = [(i, k) for i, k in enumerate(keys) if k is not None]
        if not any(k in held for k in mine):
            held.update(mine)
            kept.append(order)
    return kept


def random_rows(seed, n, values):
    rng = random.Random(seed)
    return [
        (i, *[rng.choice([None, *range(values)]) if rng.random() < 0.9 else 0 for _ in range(3)]) for i in rng.sample(range(n * 3), n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_equals_sequential(spark, seed):
    rows = random_rows(seed, 60, 12)
    df = spark.createDataFrame(rows, "ord bigint, a int, b int, c int")
    got = sorted(r.ord for r in dedupe.greedy_keep(df, "ord", ["a", "b", "c"]).collect())
    assert got == sequential_greedy(rows)


def test_greedy_with_a_hot_key_and_a_chain(spark):
    # a third of all rows share one key; another third is a chain where each row meets the next
    rows = [(i, "hot", f"u{i}", None) for i in range(40)]
    rows += [(100 + i, f"a{i // 2}", f"b{(i + 1) // 2}", None) for i in range(12)]
    rows += [(200 + i, None, None, None) for i in range(3)]
    df = spark.createDataFrame(rows, "ord bigint, a string, b string, c string")
    got = sorted(r.ord for r in dedupe.greedy_keep(df, "ord", ["a", "b", "c"]).collect())
    assert got == sequential_greedy(rows)


def test_a_long_sorted_chain_takes_few_checkpoints(spark, monkeypatch):
    cuts = []
    real = dedupe.cut_lineage
    monkeypatch.setattr(dedupe, "cut_lineage", lambda df: cuts.append(1) or real(df))
    n = 100_000
    i = F.col("id")
    df = spark.range(n).select(i.alias("ord"), F.concat(F.lit("a"), F.floor(i / 2)).alias("a"), F.concat(F.lit("b"), F.floor((i + 1) / 2)).alias("b"))
    kept = dedupe.greedy_keep(df, "ord", ["a", "b"])
    assert kept.agg(F.count("*"), F.sum(F.col("ord") % 2)).first() == (n // 2, 0)
    assert len(cuts) <= 60


def test_dedupe_against_state_is_idempotent(spark):
    rows = random_rows(3, 40, 8)
    df = spark.createDataFrame(rows, "ord bigint, a int, b int, c int").select("ord", *[F.col(k).cast("string").alias(k) for k in "abc"])
    first = dedupe.greedy_dedupe(df, "ord", ["a", "b", "c"])
    again = dedupe.greedy_dedupe(df.where("a is not null or b is not null or c is not null"), "ord", ["a", "b", "c"], [(k, first) for k in "abc"])
    assert again.count() == 0


def test_keep_first_or_blank(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "y")], "i int, k string")
    assert sorted(r.i for r in dedupe.keep_first_or_blank(df, "k", ["i"]).collect()) == [1, 3, 4, 5]


@pytest.mark.parametrize("inclusive", [True, False])
def test_carry_forward_over_chunks(spark, inclusive):
    rng = random.Random(5)
    rows = [(g, i, rng.choice([None, None, i])) for g in "ab" for i in range(50)]
    df = spark.createDataFrame(rows, "g string, i int, v int")
    chunked = scan.carry_forward(df, ["g"], "i", {"out": F.col("v")}, F.floor(F.col("i") / 7), inclusive)
    plain = scan.carry_forward(df, ["g"], "i", {"out": F.col("v")}, include_current=inclusive)
    expected, last = [], {}
    for g, i, v in rows:
        before = last.get(g)
        last[g] = v if v is not None else before
        expected.append((g, i, last[g] if inclusive else before))
    for out in (chunked, plain):
        assert sorted((r.g, r.i, r.out) for r in out.collect()) == expected


@pytest.mark.parametrize("step", [1, 10 ** 7, 10 ** 12])
@pytest.mark.parametrize("group", [["g"], []])
def test_chunks_hold_counted_rows_however_sparse_the_order(spark, monkeypatch, step, group):
    rng = random.Random(8)
    rows = [("hot" if i % 3 else "cold", i * step, rng.choice([None] * 40 + [i])) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, i bigint, v int").repartition(5)
    cut = scan.chunked(df, group, "i", chunk_rows=10)
    sizes = [r["count"] for r in cut.groupBy("_chunk").count().collect()]
    assert max(sizes) == 10 and sum(sizes) == 1500 and len(sizes) < 170
    monkeypatch.setattr(scan, "RUN_CHUNKS", 7)
    got = scan.carry_forward(df, group, "i", {"out": F.col("v")}, chunk_rows=10).collect()
    last, expected = {}, []
    for g, i, v in rows:
        name = g if group else ""
        last[name] = v if v is not None else last.get(name)
        expected.append((i, last[name]))
    assert sorted((r.i, r.out) for r in got) == expected


def test_numbers_follow_the_order(spark):
    values = random.Random(1).sample(range(1000), 300)
    df = spark.createDataFrame([(v, "hot" if v % 3 else "cold") for v in values], "v int, g string")
    got = {r.v: r.seq for r in ids.number_rows(df, ["v"], partitions=7).collect()}
    assert [got[v] for v in sorted(values)] == list(range(1, 301))
    within = ids.number_within(df, ["g"], ["v"], partitions=5).collect()
    for group in ("hot", "cold"):
        assert [r.seq for r in sorted((r for r in within if r.g == group), key=lambda r: r.v)] == list(
            range(1, sum(r.g == group for r in within) + 1))
    assert ids.number_rows(df.where("false"), ["v"]).count() == 0


def test_ids(spark):
    df = spark.createDataFrame([(7,), (10000,)], "n int")
    assert [r[0] for r in df.select(ids.padded_id(F.lit("CAP"), F.col("n"))).collect()] == ["CAP-0007", "CAP-10000"]
    stored = spark.createDataFrame([("external_acad_0009",), ("external_acad_cal_0500",), ("external_acad_10000",)], "id string")
    assert ids.next_number(stored, "id", "external_acad").first()["next_id"] == "external_acad_10001"
    assert ids.next_number(stored.where("false"), "id", "external_acad").first()["next_id"] == "external_acad_0001"


@pytest.mark.parametrize("unmatched", ["quarantine", "first"])
def test_assign_pages(spark, unmatched):
    pages = [(0, "https://f.com/Alpha/"), (1, "https://f.com/AlphaBeta"), (2, "https://f.com/gamma.page")]
    items = [
        (1, "https://f.com/alphabeta/posts/1", None), (2, "https://f.com/gamma.page", "x"), (3, "f.com/gam", None),
        (4, None, "Gamma"), (5, "https://other.org", "none"), (6, "https://f.com/ALPHA", "gamma"), (7, "", None),
    ]

    def expected(asked, name):
        asked = (asked or "").lower()
        if not asked and unmatched == "first":
            return 0
        for seq, url in pages:
            bare = url.rstrip("/").lower()
            if asked and (bare in asked or asked in bare):
                return seq
        for seq, url in pages:
            if name and name.lower() in url.lower():
                return seq
        return 0 if unmatched == "first" else None

    left = spark.createDataFrame(items, "i int, asked_url string, page_name string")
    right = spark.createDataFrame(pages, "page_seq bigint, url string")
    got = match.assign_pages(left, right, unmatched=unmatched).collect()
    assert {r.i: r.page_seq for r in got} == {i: expected(a, n) for i, a, n in items}


def test_empty_items_match_no_page(spark):
    left = spark.createDataFrame([(1, ""), (2, None), (3, "b.org"), (4, "x")], "i int, t string")
    pages = spark.createDataFrame([(5, "https://b.org/"), (6, ""), (7, "b")], "seq bigint, page string")
    got = match.with_first_overlap(left, "t", pages, F.col("page"), "seq", "found").collect()
    assert {r.i: r.found for r in got} == {1: None, 2: None, 3: 5, 4: None}


def test_unique_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "i int, k string").repartition(6)
    right = spark.createDataFrame([("hot", 1), ("k0", 2)], "k string, v int")
    got = joins.unique_left_join(left, right, ["k"]).collect()
    assert len(got) == 60 and sum(r.v == 1 for r in got) == 40 and sum(r.v == 2 for r in got) == 1


def test_tier_limits_and_costs(spark):
    tiers = ["lgu"] * 7 + ["major"] * 14 + ["quiet"] * 8
    pages = spark.createDataFrame([(t,) for t in tiers], "tier string")
    costs = {m: topk.cost_estimate(pages, topk.sweep_limits(m)[0]).first() for m in ("strong", "medium", "light", "aggressive", "none")}
    assert [costs[m].expected_posts for m in ("strong", "medium", "light", "aggressive", "none")] == [150, 72, 36, 150, 72]
    assert round(costs["strong"].estimated_cost, 2) == 0.75
    posts = spark.createDataFrame([(p, t, i) for p, t in enumerate(["lgu", "quiet", "odd"]) for i in range(20)], "p int, tier string, i int")
    got = topk.first_n_by_tier(posts, ["p"], [F.desc("i")], F.col("tier"), topk.sweep_limits("strong")[0]).groupBy("p").agg(
        F.count("*").alias("n"), F.min("i").alias("oldest")).orderBy("p").collect()
    assert [(r.n, r.oldest) for r in got] == [(8, 12), (3, 17), (3, 17)]


def test_rank_limit_applies_before_the_shuffle(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    plan = topk.first_n(rows, ["g"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_batches(spark):
    pages = spark.createDataFrame([("Eastbound", 1), ("Westbound", 2)], "batch string, i int")
    assert topk.in_batches(pages, "eastbound").count() == 1
    assert topk.in_batches(pages, " WESTBOUND , x").count() == 1
    assert topk.in_batches(pages, "a").count() == topk.in_batches(pages, "all").count() == 2


def test_budget_keeps_every_row(spark):
    posts = spark.createDataFrame([(i % 2, i) for i in range(20)], "p int, i int")
    got = topk.budget(posts, ["p"], ["i"], 3).collect()
    assert len(got) == 20 and sorted(r.i for r in got if r.within_budget) == [0, 1, 2, 3, 4, 5]


def test_slots(spark):
    df = spark.createDataFrame([("ANONAS", [f"2026-06-{d}" for d in range(18, 28)], [float(d) for d in range(10)]), ("X", ["2026-06-18"], [1.0])],
                               "code string, days array<string>, his array<double>")
    got = nested.forecast_slots(df, {"days": "forecast_date", "his": "temp_max"}, "days").select(
        nested.slot_id(F.col("code"), F.col("slot")).alias("id"), "forecast_date", "temp_max").orderBy("id").collect()
    assert len(got) == 7
    assert (got[0].id, got[0].forecast_date, got[0].temp_max) == ("FCT-ANONAS-0001", "2026-06-19", 1.0)
    assert (got[6].id, got[6].forecast_date) == ("FCT-ANONAS-0007", "2026-06-25")


def test_month_matrix_round_trip(spark):
    sheet = spark.createDataFrame([
        (0, "JANUARY", "1,000", "7"), (1, "February ", "", "8"), (2, "march", "3", "x"), (3, "notes", "9", "9"), (4, "TOTAL", "1,003", "15"), (5, "april", "-2", None),
    ], "row_idx bigint, `Month` string, `2023` string, `2024` string")
    rows = reshape.month_matrix(sheet, "Month", ["2023", "2024"])
    got = {r.id: (r.month_number, r.month_name, r.value) for r in reshape.number_months(rows.where("reject_reason is null")).collect()}
    assert got == {
        "STU2023-0001": (1, "January", 1000), "STU2023-0002": (3, "March", 3), "STU2023-TOTAL": (None, "Total", 1003),
        "STU2024-0001": (1, "January", 7), "STU2024-0002": (2, "February", 8), "STU2024-TOTAL": (None, "Total", 15)}
    assert [(r.month_name, r.reject_reason) for r in rows.where("reject_reason is not null").collect()] == [("April", "negative")]


def test_daily_totals_ignore_total_rows(spark):
    rows = spark.createDataFrame([("d", "7-9am (AM PEAK)", "a", 3), ("d", "5-7pm (PM PEAK)", "a", None), ("d", "Daily Total", "a", 3), ("d", "x", "b", None)],
                                 "date string, period string, name string, v int")
    args = (rows, ["name"], "date", "period", "v")
    assert [r.v for r in reshape.daily_totals(*args).collect()] == [3]
    assert [r.v for r in reshape.daily_totals(*args, count_existing_totals=True).collect()] == [6]


def test_merges_are_idempotent(spark):
    stored = spark.createDataFrame([(1, "a", "t0"), (2, "b", "t0")], "id int, v string, stamp string")
    new = spark.createDataFrame([(2, "B", "t1", 9), (3, "C", "t1", 9)], "id int, v string, stamp string, extra int")
    touched = merge.insert_or_touch(stored, new, ["id"], "stamp", F.lit("now"))
    assert sorted(tuple(r) for r in touched.collect()) == [(1, "a", "t0", None), (2, "b", "now", None), (3, "C", "now", 9)]
    twice = merge.insert_or_touch(touched, new, ["id"], "stamp", F.lit("now"))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, touched.collect()))
    full = merge.upsert(stored, new.drop("extra"), ["id"])
    assert sorted(map(tuple, merge.upsert(full, new.drop("extra"), ["id"]).collect())) == [(1, "a", "t0"), (2, "B", "t1"), (3, "C", "t1")]
    assert [r.id for r in merge.insert_if_absent(stored, new, ["id"]).collect()] == [3]
    updated = merge.update_only(stored, new.drop("extra"), ["id"])
    assert sorted(map(tuple, updated.collect())) == [(1, "a", "t0", False), (2, "B", "t1", True)]
    assert tuple(merge.update_report(stored, new, ["id"]).first()) == (1, 1)


def test_checks(spark):
    df = checks.with_rejects(spark.createDataFrame([("f", 1), ("f", -1), ("g", 2), ("g", None)], "file string, v int"), {"sign": F.col("v") >= 0})
    assert sorted((r.file, r.rows, r.bad_rows, r.accepted) for r in checks.group_status(df, ["file"]).collect()) == [("f", 2, 1, False), ("g", 2, 0, True)]
    assert [r.file for r in checks.whole_groups(df, ["file"]).collect()] == ["g", "g"]
    assert checks.accepted(df).count() == 3 and checks.quarantined(df).count() == 1


def test_fallback_levels(spark):
    rows = [(1, None, None), (2, 20.0, 50.0), (3, None, None), (4, 25.0, None)]
    df = spark.createDataFrame(rows, "seq int, t double, h double").withColumn("ok", F.col("t").isNotNull())
    near = gapfill.fill_from_neighbours(df, [], "seq", ["t", "h"], F.col("ok"))
    filled = gapfill.fallback_chain(near, ["t", "h"], [("fresh", F.col("ok"), ""), ("neighbour", F.col("has_near"), "_near")], {"t": 28.5, "h": 75.0})
    got = gapfill.take_filled(filled, ["seq"], ["t", "h"]).orderBy("seq").collect()
    assert [tuple(r)[1:] for r in got] == [(28.5, 75.0, "constant"), (20.0, 50.0, "fresh"), (20.0, 50.0, "neighbour"), (25.0, 75.0, "fresh")]


def test_forward_fill_of_continuation_rows(spark):
    df = spark.createDataFrame([("t", 0, "A", "x"), ("t", 1, " ", "y"), ("t", 2, "B", ""), ("t", 3, None, "z")], "t string, i int, c string, d string")
    got = reshape.forward_fill_blank(df, ["t"], "i", ["c"]).orderBy("i").collect()
    assert [(r.c, r.d) for r in got] == [("A", "x"), ("A", "y"), ("B", ""), ("B", "z")]


def test_cancellation_cascade(spark):
    rows = [(1, "s", "STRIKE", None, False, 1), (2, "s", "STRIKE", "STRIKE", True, 2), (3, "s", "STRIKE", None, False, 3), (4, "o", "STRIKE", None, False, 1)]
    df = spark.createDataFrame(rows, "i int, source_name string, event_code string, cancellation_target_code string, is_cancellation boolean, post_date int")
    assert {r.i: r.is_active for r in tagging.cancel_earlier(df).collect()} == {1: False, 2: True, 3: True, 4: True}


def test_extract_runs_once_per_value(spark):
    df = spark.createDataFrame([(1, "u"), (2, "u"), (3, None), (4, "v")], "i int, uri string")
    seen = []

    def extract(distinct):
        seen.append(distinct.count())
        return distinct.withColumn("t", F.upper("uri"))

    got = dedupe.once_per_value(df, "uri", extract, "t").orderBy("i").collect()
    assert seen == [2] and [r.t for r in got] == ["U", "U", None, "V"]


def test_a_new_suspension_is_no_cancellation(spark):
    texts = ["walang pasok bukas: all classes cancelled due to typhoon", "classes suspended, concert cancelled", "suspended classes lifted", "midterms cancelled"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = tagging.tag_events(df, F.col("t")).orderBy("i").collect()
    assert [r.is_cancellation for r in got] == [False, False, True, True]


def test_cells_of_a_sheet_are_neither_sorted_nor_read_twice(spark, monkeypatch):
    from railtide.operators import sheets
    from railtide.registry import sheets as queries

    numbered, cut = [], []
    number, chunk = queries.ids.number_within, sheets.chunked
    monkeypatch.setattr(queries.ids, "number_within", lambda df, *more: (numbered.append(df), number(df, *more))[1])
    monkeypatch.setattr(sheets, "chunked", lambda df, *more: (cut.append(df), chunk(df, *more))[1])
    grid = queries.event_grid(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    assert sheets.blocks(grid).count() > 0
    assert [("cells" in df.columns) for df in numbered] == [False]
    # what is range partitioned was written before
    assert [df._jdf.queryExecution().optimizedPlan().nodeName() for df in cut] == ["LogicalRDD"]


def test_rarest_pieces_are_found_without_sorts(spark, monkeypatch):
    from railtide.operators import match

    needles = spark.createDataFrame([("https://a.org/one",), ("https://a.org/two",), ("ab",), ("aaaaaaaa",)], "needle string")
    found = match._rarest_piece(needles)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortOrder", "")
    pieces = {r.needle: r.piece for r in found.collect()}
    assert pieces["ab"] == "ab" and pieces["aaaaaaaa"] == "aaaaaa"
    for end in ("one", "two"):
        needle = f"https://a.org/{end}"
        assert pieces[needle] in needle and any(pieces[needle].endswith(end[: n + 1]) for n in range(3))
    # where all hashes are the same, a needle still gets a piece that it has
    monkeypatch.setattr(match, "MARK", 0)
    assert all(r.piece in r.needle for r in match._rarest_piece(needles).collect())
