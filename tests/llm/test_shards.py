import random
import zlib
from collections import Counter, defaultdict

import pytest

from railtide.llm import shards

FOLDER = "/root/testdata/sf0.01"


def slow_best_fit(sizes, capacity):
    """One item at a time: the tightest bin that it fits, else a new one."""
    free = []
    for size in sorted(sizes, reverse=True):
        fitting = [(f, i) for i, f in enumerate(free) if f >= size]
        if fitting:
            free[min(fitting)[1]] -= size
        else:
            free.append(max(capacity, size) - size)
    return sorted(free)


@pytest.mark.parametrize("seed", range(5))
def test_whole_sizes_at_once_equal_single_steps(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, 40) for _ in range(300)]
    capacity = 100
    placed = shards.best_fit(sorted(Counter(sizes).items(), reverse=True), capacity)
    used = defaultdict(int)
    for size, chosen, n in placed:
        used[chosen] += size * n
    assert sorted(capacity - u for u in used.values()) == slow_best_fit(sizes, capacity)


@pytest.mark.parametrize("sizes", [[57] * 300, [1000, 999, 5, 5, 5], [3], list(range(1, 200))])
def test_all_items_are_packed(sizes):
    placed = shards.pack(sorted(Counter(sizes).items()), 7)
    assert Counter(s for s, _, n in placed for _ in range(n)) == Counter(sizes)
    held = Counter()
    for s, b, n in placed:
        held[b] += s * n
    assert all(0 <= b < 7 for b in held)
    share = sum(sizes) / 7
    if max(sizes) < share / 4:
        assert max(held.values()) - min(held[b] for b in range(7)) <= max(sizes)


def check(rows, got, count=24):
    assert len(got) == len(rows)
    of_text = {}
    for doc, text in [(r[0], r[1] or "") for r in rows]:
        of_text.setdefault((doc, len(text.encode()) + 8, zlib.crc32(text.encode())), text)
    shard_of, slots = {}, defaultdict(list)
    for r in got:
        text = of_text[(r["doc_id"], r["size"], r["text_crc32"])]
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        assert 0 <= r["shard"] < count
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    return [held[s] for s in range(count)]


def test_whole_table_is_even(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = check([(r["doc_id"], r["text"]) for r in docs.collect()], shards.op4(docs).collect())
    assert max(held) - min(held) < 0.02 * sum(held) / 24


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(odd_rows, shards.op4(odd_docs).collect())
    assert shards.op4(no_docs).collect() == []


def test_a_group_larger_than_a_share_is_alone(docs_of):
    rows = [(i, "copy " * 40) for i in range(300)] + [(1000 + i, f"text {i} " * 5) for i in range(300)]
    got = shards.op4(docs_of(rows)).collect()
    held = check(rows, got)
    big = next(r["shard"] for r in got if r["doc_id"] == 0)
    assert {r["doc_id"] for r in got if r["shard"] == big} == set(range(300))
    rest = [h for s, h in enumerate(held) if s != big]
    assert max(rest) - min(rest) < 0.12 * max(rest)


def test_grades():
    assert [shards.grade(n) for n in (1, 4095, 4096, 4097, 8191)] == [1, 4095, 4096, 4098, 8192]


def test_grade_column(spark):
    values = [1, 8, 4095, 4096, 4097, 12345, 999_999, 10**12 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = dict(df.select("v", shards.grade_column(df["v"])).collect())
    assert got == {v: shards.grade(v) for v in values}


def test_pipeline_form_keeps_columns(odd_docs, odd_rows):
    out = shards.with_shard(odd_docs)
    assert set(out.columns) == set(odd_docs.columns)
    assert out.count() == len(odd_rows)
