import hashlib
import re
from collections import Counter, defaultdict

from railtide.llm import mixing

FOLDER = "/root/testdata/sf0.01"


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare the excess until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if rate * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: rate * weight[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def slow_mix(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size):
        total[r[2]] += n
    targets = slow_targets(total)
    out = []
    for source in total:
        rate = targets[source] / total[source] if total[source] else 0.0
        whole, wanted = int(rate), targets[source] - int(rate) * total[source]
        inside = []
        for r, n in zip(rows, size):
            if r[2] == source:
                digits = hashlib.md5(f"{'' if r[0] is None else r[0]}|mix".encode()).hexdigest()[:13]
                u = (int(digits, 16) + 0.5) / (1 << 52)
                p = rate - whole
                odds = u / (1 - u) / (p / (1 - p)) if p > 0 else 0
                inside.append((odds, r[0] if r[0] is not None else -(1 << 63), n, r))
        before = 0
        for _, _, n, r in sorted(inside, key=lambda x: x[:3]):
            drawn = rate > whole and 2 * before + n <= 2 * wanted
            out.append((str(r[0]), n, total[source], round(targets[source], 6), n * (whole + drawn)))
            before += n
    return sorted(out)


def check(df, rows):
    got = sorted((str(r[0]), r[1], r[2], round(r[3], 6), r[4]) for r in mixing.op7(df).collect())
    assert got == slow_mix(rows)
    return got


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    got = check(docs, rows)
    source = {str(r[0]): r[2] for r in rows}
    taken, target, largest = Counter(), {}, Counter()
    for doc, n, _, t, words in got:
        taken[source[doc]] += words
        target[source[doc]] = t
        largest[source[doc]] = max(largest[source[doc]], n)
        assert words <= 2 * n
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(odd_docs, [(*r[:2], r[2] if len(r) > 2 else "src0") for r in odd_rows])
    assert mixing.op7(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


def test_small_sources_stop_at_twice_their_size(docs_of):
    rows = [(i, "a b c", "big") for i in range(400)] + [(900 + i, "a b", s) for i, s in enumerate(["tiny", None, "zz"] * 3)]
    check(docs_of(rows), rows)


def test_rows_of_the_mix_add_up_to_what_is_taken(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.op7(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    times = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert all(times[i] * size == n for i, (n, size) in taken.items())
    assert {r["doc_id"]: r["n"] for r in mixing.mix(docs).groupBy("doc_id").agg({"*": "count"}).toDF("doc_id", "n").collect()} == dict(times)


def test_pipeline_form_keeps_columns(odd_docs):
    """Rows come whole, as often as the query says, whatever other columns are called."""
    from collections import Counter

    out = mixing.mix(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert all(r["_one"] == r["_cut"] == "x" for r in rows)
    got, taken = Counter(), Counter()
    for r in rows:
        got[r["doc_id"]] += len(re.findall(mixing.WORD, r["text"] or ""))
    for r in mixing.op7(odd_docs).collect():
        taken[r["doc_id"]] += r["taken"]
    assert +got == +taken
