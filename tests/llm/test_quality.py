import math
import zlib
from collections import defaultdict

import numpy as np

from railtide.llm import quality

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.op5(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    judged = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in judged]) > 0.95
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).select("doc_id").collect()}
    assert kept == {i for i, r in got.items() if r["predicted"]}


def test_equal_texts_score_alike_and_reruns_agree(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, 0), (8, 0, 0), (5, None, 0), (None, 1, 0), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    first = [sorted(map(str, quality.op5(odd_docs, labels).collect())) for _ in range(2)]
    assert first[0] == first[1]
    rows = quality.op5(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (6, 7)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_no_labels_and_no_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.op5(odd_docs, labels).collect()} == {0.5}
    assert quality.op5(no_docs, labels).collect() == []


def test_sparse_scores_equal_a_dense_product():
    texts = ["A b b, c", "", "x x x"]
    weights = np.random.default_rng(1).normal(size=(1 << 8) + 1)
    run = [t.encode() for t in texts]
    text, feature, value = quality.features(run, 8)
    dense = np.zeros((3, 1 << 8))
    np.add.at(dense, (text, feature), value)
    assert np.allclose((dense**2).sum(axis=1), [1, 0, 1])
    assert np.allclose(np.bincount(text, weights[feature] * value, minlength=3), dense @ weights[:-1])


def slow_train(rows, epochs):
    """Follow-the-regularised-leader, one coordinate at a time; ``rows`` are ({feature: value}, label)."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for x, y in rows:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_training_against_plain_loops():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdefgh"), size=rng.integers(0, 12))) for _ in range(40)] + ["", "a a a a", "é … !"]
    good = rng.integers(0, 2, len(texts)).astype(float)
    for bits, epochs in ((4, 1), (9, 3)):
        rows = []
        for t, y in zip(texts, good):
            _, feature, value = quality.features([t.encode()], bits)
            rows.append((dict(zip(feature.tolist(), value.tolist())) | {1 << bits: 1.0}, y))
        expected = np.zeros((1 << bits) + 1)
        for i, w in slow_train(rows, epochs).items():
            expected[i] = w
        assert np.allclose(quality.train(texts, good, bits, epochs), expected, atol=1e-5)
