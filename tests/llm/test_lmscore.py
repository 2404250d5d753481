import math
import re
from collections import Counter

import pytest

from railtide.llm import lmscore


def slow_scores(rows, target):
    """The same models with dictionaries and without hashing."""
    lowered = {i: ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t or "")]
               for i, (_, t) in enumerate(rows)}
    seen = Counter(w for ws in lowered.values() for w in ws)
    texts = {i: ["<s>", *(w if seen[w] >= 2 else "<unk>" for w in ws)] for i, ws in lowered.items()}
    known = sum(n >= 2 for n in seen.values())
    models = []
    for members in ([i for i in texts if rows[i][0] in target], list(texts)):
        single = Counter(w for i in members for w in texts[i][1:])
        before = Counter(w for i in members for w in texts[i][:-1])
        pairs = Counter(p for i in members for p in zip(texts[i], texts[i][1:]))
        models.append((single, before, pairs))
    out = []
    for i, words in texts.items():
        losses = []
        for single, before, pairs in models:
            loss = 0.0
            for v, w in zip(words, words[1:]):
                p = (single[w] + 1) / (sum(single.values()) + known + 1)
                context = before["<s>"] if v == "<s>" else single[v]
                loss -= math.log2((pairs[v, w] + lmscore.PULL * p) / (context + lmscore.PULL))
            losses.append(loss / max(1, len(words) - 1))
        out.append((len(words) - 1, *losses))
    return out


def check(spark, df, rows, target):
    frame = spark.createDataFrame([(t,) for t in target], "doc_id bigint")
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["target_loss"], r["background_loss"], r["score"]) for r in lmscore.score_documents(df, frame).collect())
    expected = sorted((str(r[0]), *s, s[1] - s[2]) for r, s in zip(rows, slow_scores(rows, set(target))))
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected):
        assert g[2:] == pytest.approx(e[2:], abs=1e-4)


def test_against_plain_counts(spark, docs_of):
    rows = [(1, "The cat sat. The cat ran."), (2, "the dog sat; a dog ran"), (3, "ÜBER alles"), (4, ""), (5, None), (6, "... !!"), (7, "cat cat cat")]
    check(spark, docs_of(rows), rows, [1, 7, 99])


def test_target_like_texts_score_lower(spark, docs_of):
    rows = [(i, "red green blue red green " * 3) for i in range(10)] + [(20 + i, "one two three four two " * 3) for i in range(10)]
    frame = spark.createDataFrame([(i,) for i in range(10)], "doc_id bigint")
    got = {r["doc_id"]: r["score"] for r in lmscore.score_documents(docs_of(rows), frame).collect()}
    assert max(got[i] for i in range(10)) < min(got[20 + i] for i in range(10))


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (None, 1, 0), (8, None, 0)], "doc_id bigint, quality int, toxic int")
    got = lmscore.op6(odd_docs, labels).collect()
    assert len(got) == len(odd_rows)
    assert all(r["score"] == 0 and r["n_tokens"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert len({r["score"] for r in got if r["doc_id"] in (6, 7)}) == 1
    assert lmscore.op6(no_docs, labels).collect() == []
    assert lmscore.op6(odd_docs, labels.where("false")).count() == len(odd_rows)


def test_more_pairs_than_any_fixed_table(spark, docs_of):
    """5 million different pairs of 300,000 words; each comes as often as counted."""
    import numpy as np

    rng = np.random.default_rng(8)
    drawn = rng.integers(0, 300_000, (2500, 2000))
    rows = [(i, " ".join(f"q{w:x}" for w in line)) for i, line in enumerate(drawn.tolist())]
    target = list(range(0, 2500, 5))
    frame = spark.createDataFrame([(t,) for t in target], "doc_id bigint")
    df = docs_of(rows[:0]).unionByName(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs_of([]).schema).repartition(8))
    got = {r["doc_id"]: (r["target_loss"], r["background_loss"]) for r in lmscore.score_documents(df, frame).collect()}
    assert len(got) == 2500

    losses = []
    known = np.bincount(drawn.ravel(), minlength=300_000) >= 2
    words = np.where(known[drawn], drawn, 300_000)
    before = np.hstack([np.full((2500, 1), 300_001), words[:, :-1]])
    pair = before * 300_002 + words
    for part in (np.arange(0, 2500, 5), np.arange(2500)):
        single = np.bincount(words[part].ravel(), minlength=300_002)
        context = single.copy()
        context[300_001] = len(part)
        keys, n = np.unique(pair[part], return_counts=True)
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        both = np.where(keys[at] == pair, n[at], 0)
        p = (both + lmscore.PULL * (single[words] + 1) / (single.sum() + known.sum() + 1)) / (context[before] + lmscore.PULL)
        losses.append(-np.log2(p).mean(axis=1))
    assert len(np.unique(pair)) > 1 << 22
    assert np.abs(np.array([got[i] for i in range(2500)]) - np.array(losses).T).max() < 1e-6


def test_many_chunks_and_ranges(spark, docs_of, monkeypatch):
    """Counts meet across chunks and ranges, also for repeated rows, NULL keys and empty texts."""
    import random

    monkeypatch.setattr(lmscore, "CHUNK_BYTES", 300)
    monkeypatch.setattr(lmscore, "RANGE_ENTRIES", 40)
    rng = random.Random(12)
    rows = [(i % 50 if i % 9 else None, " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(25)))) for i in range(120)]
    rows += [(60, None), (61, ""), (3, rows[3][1])]
    check(spark, docs_of(rows), rows, [3, 4, 8, 60, 77])
