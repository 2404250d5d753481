import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from railtide.llm import simhash
from railtide.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def slow_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """prints: list of (doc_id, print) -> smallest doc_id reachable."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least.setdefault(find(i), []).append(doc)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(prints))]


def check(df, rows):
    prints = [(r[0], slow_print(r[1])) for r in rows]
    expected = sorted((str(d), format(p, "016x"), str(c)) for (d, p), c in zip(prints, slow_components(prints)))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in simhash.op10(df).collect()) == expected


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(odd_docs, odd_rows):
    check(odd_docs, odd_rows)


def test_near_copies(docs_of):
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    rows = []
    for i in range(60):
        changed = list(base)
        for _ in range(i % 9):
            changed[rng.randrange(400)] = f"new{i}"
        rows.append((100 - i, " ".join(changed)))
    check(docs_of(rows), rows)


def test_every_pair_within_three_bits_shares_a_list():
    masks = simhash.posting_masks()
    rng = random.Random(5)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)
        tally = simhash.shared_bytes(np.array([a], np.uint64), np.array([b], np.uint64))[0]
        assert tally >= 5


def test_spanning_links_join_what_all_pairs_join():
    rng = np.random.default_rng(2)
    members = np.unique(rng.integers(0, 1 << 9, 60).astype(np.uint64))
    a, b = simhash._spanning(members, 1)
    assert len(a) < len(members)
    assert all((int(x) ^ int(y)).bit_count() <= 1 for x, y in zip(a, b))
    found = slow_components([(int(m), int(m) << 3 | int(m) << 20 | int(m) << 40) for m in members])
    near = {}
    for x, y in zip(a.tolist(), b.tolist()):
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    for m, least in zip(members.tolist(), found):
        seen, todo = {m}, [m]
        while todo:
            for n in near.get(todo.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        assert min(seen) == least


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 100)], [(5, 5)], [], [(-3, 9), (9, 4), (7, 8)],
])
def test_components(spark, links):
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    nodes = {n for a, b in links if a != b for n in (a, b)}
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_one_document_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 8, 9, 10] or sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 9, 10]
    assert ids.count(None) == 2
    assert simhash.op10(no_docs).collect() == [] and simhash.keep_first(no_docs).collect() == []


def near(a, b):
    return bin(a ^ b).count("1") <= 3


def slow_first(rows):
    """(doc_id, text) of one row of each component over all pairs of fingerprints."""
    prints = [simhash.fingerprint(text or "") for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near(prints[i], prints[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, text) in enumerate(rows):
        key = (doc, hashlib.md5((text or "").encode()).digest(), text or "")
        groups[find(i)] = min(groups.get(find(i), key), key)
    return sorted((doc, text) for doc, _, text in groups.values())


def test_rows_of_one_doc_id_are_told_apart(docs_of):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(12)]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[0]), (6, texts[1]), (4, texts[2]), (4, texts[3]), (3, texts[3]), (9, None), (8, "")]
    rows += [(20 + i % 4, t) for i, t in enumerate(texts[4:])] * 2
    kept = simhash.keep_first(docs_of(rows)).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert sorted(map(tuple, kept)) == slow_first(rows)
    assert {(5, texts[0]), (5, texts[1]), (3, texts[3]), (4, texts[2]), (8, "")} <= set(map(tuple, kept))


def test_other_columns_and_their_names_stay(docs_of):
    names = ["row", "place", "_place", "_first", "root", "least", "node", "key", "digest", "print"]
    df = docs_of([(1, "a b c d"), (2, "a b c d"), (3, "x y z")]).select("*", *[F.lit(n).alias(n) for n in names])
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3] and all(r[n] == n for r in kept.collect() for n in names)
