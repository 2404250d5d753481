import hashlib
import random

import numpy as np
import pytest

from railtide.llm import repeats, suffixes


def slow(rows):
    """Every string of LENGTH bytes in order of (doc_id, start)."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - repeats.LENGTH + 1):
            s = data[i : i + repeats.LENGTH]
            if s in seen:
                covered[i : i + repeats.LENGTH] = b"\1" * repeats.LENGTH
            seen.add(s)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(c and (i == 0 or not covered[i - 1]) for i, c in enumerate(covered))
        out[doc] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(df, rows):
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.op3(df).collect()}
    assert got == slow(rows)


def planted(seed, docs=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(60, 400))) for _ in range(8)]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p)), 2))
            parts.append(rng.choice([p, p[a:b], p[: len(p) // 2] + "é" + p[len(p) // 2 :], "".join(rng.choice("gh ij") for _ in range(rng.randrange(5, 150)))]))
        rows.append((rng.randrange(10**6) * 100 + i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_string(docs_of, seed):
    rows = planted(seed)
    check(docs_of(rows).repartition(5), rows)


def test_runs_cycles_and_copies(docs_of):
    rows = [(1, "a" * 350), (2, "ab" * 200), (3, "ab" * 200), (4, None), (5, ""), (6, "a" * 99), (7, "x" + "a" * 100), (8, "y" * 100), (9, "y" * 100),
            (10, "\0" * 130), (11, "é\0" * 90)]
    check(docs_of(rows), rows)


def test_frequent_anchors_take_the_other_way(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_STRETCHES", 3)
    rows = planted(3)
    check(docs_of(rows).repartition(4), rows)


def test_repeated_keys(docs_of, odd_docs, odd_rows, no_docs):
    got = repeats.op3(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert {(r["n_removed"], r["doc_id"]) for r in got if r["doc_id"] in (6, 7)} == {(0, 6), (got_bytes(odd_rows, 7), 7)}
    assert repeats.op3(no_docs).collect() == []


def got_bytes(rows, doc):
    return next(len(r[1].encode()) for r in rows if r[0] == doc)


@pytest.mark.parametrize("strings", [[b"banana", b"ananas"], [b"aaaa"], [b""], [b"", b"\0\0", b"\xff\xff\0"], [b"abracadabra" * 9, b"cadabra" * 5]])
def test_suffix_order(strings):
    sym, starts = suffixes.symbols(strings)
    order = suffixes.suffix_order(sym, suffixes.packed(sym, 200), 200)
    assert order.tolist() == sorted(range(len(sym)), key=lambda i: sym[i:].tolist())
    same = suffixes.share_prefix(order, suffixes.packed(sym, 200), 10)
    padded = np.append(sym, np.zeros(20, np.uint16))
    assert same.tolist() == [i > 0 and bool((padded[a : a + 10] == padded[order[i - 1] : order[i - 1] + 10]).all()) for i, a in enumerate(order)]
