import itertools
import math
import random

import pytest

from railtide.llm import decontaminate

BENCH = "item_id bigint, text string"


def flags(df, bench):
    return {r["doc_id"]: r["contaminated"] for r in decontaminate.op2(df, bench).collect()}


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def slow_flags(rows, items):
    """Every place of every item in every text, without seeds."""
    out = {}
    for doc, text in rows:
        tokens = text.lower().split()
        hit = False
        for item in (i.lower().split() for i in items):
            if len(item) < decontaminate.LEAST_WORDS:
                hit |= bool(item) and item == tokens
                continue
            w = min(len(item), decontaminate.WINDOW)
            for shift in range(-len(item) + 1, len(tokens)):
                same = [0 <= shift + j < len(tokens) and tokens[shift + j] == t for j, t in enumerate(item)]
                hit |= any(sum(same[j : j + w]) >= 0.8 * w for j in range(len(item) - w + 1))
        out[doc] = hit
    return out


@pytest.fixture
def case(spark):
    rng = random.Random(11)
    items = [words(rng, n) for n in (40, 25, 16, 9, 5, 3)]
    rows = []
    for i in range(120):
        text = words(rng, rng.randrange(0, 80))
        if i % 2:
            item = list(items[i % 6])
            cut = rng.randrange(len(item)) if i % 5 == 0 else 0
            item = item[cut:]
            for _ in range(i % 4):
                if len(item) > 20:
                    item[rng.randrange(len(item))] = "other"
            at = rng.randrange(len(text) + 1)
            text[at:at] = item
        rows.append((i, " ".join(text)))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], BENCH)
    return rows, [" ".join(t) for t in items], bench


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_every_place(case, docs_of, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    rows, items, bench = case
    got, expected = flags(docs_of(rows), bench), slow_flags(rows, items)
    assert not [d for d in got if got[d] and not expected[d]]
    assert got == expected


def test_substitutions_case_and_marks_are_seen_through(spark, docs_of):
    rng = random.Random(4)
    item = words(rng, 30)
    changed = [w if rng.random() > 0.1 else "x" for w in item]
    frame = spark.createDataFrame([(1, " ".join(item))], BENCH)
    styled = "*** ".join(w.upper() for w in changed)
    assert flags(docs_of([(1, styled)]), frame)[1] == slow_flags([(1, " ".join(changed))], [" ".join(item)])[1]


def test_short_items_are_whole_texts(spark, docs_of):
    """Items of one to four words: found where they are the whole text, however written; else left alone."""
    bench = spark.createDataFrame([(1, "Yes."), (2, "the red cat"), (3, "a b c d"), (4, "..."), (5, "the red cat")], BENCH)
    rows = [(1, "yes"), (2, "yes yes"), (3, "The red, CAT!"), (4, "see the red cat"), (5, "a b c d"), (6, "a b c"), (7, "..."), (8, None), (1, "yes")]
    got = decontaminate.op2(docs_of(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["equal"]) for r in got if r["contaminated"]) == [(1, 1, 1.0), (1, 1, 1.0), (3, 2, 1.0), (5, 3, 1.0)]
    assert len(got) == len(rows)
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs_of(rows), bench).collect()) == [2, 4, 6, 7, 8]


def test_sql_agrees(case, docs_of, spark):
    """The query and its SQL on items of 3 to 40 words with substitutions."""
    import duckdb

    rows, items, bench = case
    con = duckdb.connect()
    con.register("documents", docs_of(rows).select("doc_id", "text").toPandas())
    con.register("benchmark", bench.toPandas())
    told = con.execute(decontaminate.OP2_SQL).fetch_df()
    columns = ["doc_id", "contaminated", "n_items", "equal"]
    expected = sorted(map(tuple, told[columns].itertuples(index=False)))
    got = sorted(tuple(r[c] for c in columns) for r in decontaminate.op2(docs_of(rows), bench).collect())
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expected])


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, odd_rows[5][1]), (3, odd_rows[5][1]), (4, "one two"), (None, "a b c d e f")], BENCH)
    got = decontaminate.op2(odd_docs, bench).collect()
    assert len(got) == len(odd_rows)
    assert {r["doc_id"] for r in got if r["contaminated"]} == {6, 7, 8}
    kept = decontaminate.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in odd_rows if r[0] not in (6, 7, 8))
    assert decontaminate.op2(no_docs, bench).collect() == []
    assert decontaminate.op2(odd_docs, bench.where("false")).where("contaminated").count() == 0


def test_no_python_runs(spark, docs_of):
    plan = decontaminate.op2(docs_of([(1, "a")]), spark.createDataFrame([(1, "a b c d e f")], BENCH))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", range(decontaminate.LEAST_WORDS, decontaminate.WINDOW + 1))
def test_every_overlap_that_is_accepted_holds_a_seed(n):
    places = [{at + i for i, c in enumerate(m) if c == "1"} for m in decontaminate.SEEDS[n] for at in range(n - len(m) + 1)]
    differ = n - math.ceil(decontaminate.SHARE * n)
    assert all(any(not p & set(spoilt) for p in places) for spoilt in itertools.combinations(range(n), differ))


def test_no_overlap_of_any_length_is_missed(spark, docs_of):
    """All substitutions of items of 5 to 16 words, also cut off by the end of the text."""
    rng = random.Random(31)
    items = [[f"i{n}w{j}" for j in range(n)] for n in range(5, 17)]
    texts = []
    for item in items:
        w = min(len(item), 15)
        spoilt = list(itertools.combinations(range(w), w - math.ceil(0.8 * w)))
        for pattern in rng.sample(spoilt, min(len(spoilt), 60)):
            texts.append(["a", *["x" if j in pattern else t for j, t in enumerate(item)], "b"])
        texts.append(["a", *["x" if j < 1 + w - math.ceil(0.8 * w) else t for j, t in enumerate(item[:w])], "b"])
        texts.append(item[w - math.ceil(0.8 * w) : w])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], BENCH)
    expected = slow_flags(rows, [" ".join(t) for t in items])
    assert flags(docs_of(rows), bench) == expected
    assert 0 < sum(expected.values()) < len(rows)
