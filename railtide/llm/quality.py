"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from railtide.llm.wordhash import U64, chunks, pairs_of, words_of

# hashed features: the model has this many weights whatever the corpus
BITS = 18
# labelled documents the model is fitted on at most, those with the smallest hash of their id
TRAIN_ROWS = 16_384
# models trained side by side and averaged
SHARDS = 8
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
THRESHOLD = 0.3
REPEATED = U64(0x5851F42D4C957F2D)


def features(run: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the text, feature, value) of words and word pairs; each text's values have length 1.

    Words keep their case, and runs of punctuation are words.
    """
    words, owner = words_of(run)
    both, pair_owner = pairs_of(words, owner)
    # a word after itself is one feature, whatever the word
    again = (words[1:] == words[:-1])[owner[1:] == owner[:-1]]
    both[again] = REPEATED
    every = np.concatenate([words, both])
    key = np.concatenate([owner, pair_owner]).astype(U64) << U64(bits) | every >> U64(64 - bits)
    key, count = np.unique(key, return_counts=True)
    text = (key >> U64(bits)).astype(np.int64)
    count = count.astype(np.float64)
    length = np.sqrt(np.bincount(text, count * count, minlength=len(run)))
    return text, (key & U64((1 << bits) - 1)).astype(np.int64), count / length[text]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[str], good: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes in the given order; the last weight is the bias."""
    size = 1 << bits
    rows = []
    for run in chunks(texts):
        text, feature, value = features(run, bits)
        cuts = np.searchsorted(text, np.arange(len(run) + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows.append((np.append(feature[a:b], size), np.append(value[a:b], 1.0)))
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        zi, ni = z[at], n[at]
        return -(zi - np.sign(zi) * np.minimum(np.abs(zi), L1)) / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    for _ in range(epochs):
        for (at, x), y in zip(rows, good):
            w = weights(at)
            g = (sigmoid(w @ x) - y) * x
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights(np.arange(size + 1)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        max_rows: int = TRAIN_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learnt from at most ``max_rows`` labelled documents.

    The sample is the labelled ids with the smallest hash, so it depends on nothing but the ids.
    An id with several labels counts as good only if all say so; NULL labels and ids are no labels.
    Without any labelled text all weights are 0 and every score is 0.5.
    """
    place = F.xxhash64(F.col(key))
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_good"))
        .select("_key", "_good", F.xxhash64("_key").alias("_place")).orderBy("_place", "_key").limit(max_rows)
    )
    # at most max_rows ids, a stated parameter, are broadcast
    sample = (
        docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .join(F.broadcast(chosen), "_key")
        .select("_text", "_good", "_place", F.pmod(F.shiftright("_place", 8), F.lit(SHARDS)).alias("_shard"))
    )

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_place", "_text"])
        learnt = train(list(frame["_text"]), frame["_good"].to_numpy(float), bits)
        return pd.DataFrame({"rows": [len(frame)], "weights": [learnt.tobytes()]})

    parts = sample.groupBy("_shard").applyInPandas(learn, "rows long, weights binary").collect()
    if not parts:
        return np.zeros((1 << bits) + 1, dtype=np.float32)
    held = np.array([r["rows"] for r in parts], dtype=float)
    stacked = np.stack([np.frombuffer(r["weights"], dtype=np.float32) for r in parts])
    order = np.lexsort((stacked[:, -1], held))  # the sum does not depend on the order of arrival
    return (np.average(stacked[order], axis=0, weights=held[order])).astype(np.float32)


def scorer(spark, weights: np.ndarray, bits: int = BITS):
    """A Column function: text to the probability that its label is 1; NULL is the empty text."""
    shared = spark.sparkContext.broadcast(weights)

    @pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        w = shared.value
        out = []
        for run in chunks(list(values)):
            text, feature, value = features(run, bits)
            out.append(np.bincount(text, w[feature] * value, minlength=len(run)) + w[-1])
        return pd.Series(sigmoid(np.concatenate(out)) if out else [], dtype="float64")

    return lambda value: score(F.coalesce(value, F.lit("")))


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
                  out: str = "score", **options) -> DataFrame:
    """``docs`` with the probability of the label 1 in ``out`` (a column of that name is replaced).

    Scores use whole texts only, so equal texts have equal scores, also on repeated rows.  The
    empty text's score is the bias.  Scoring is a map over the scan's partitions.
    """
    weights = fit(docs, labels, text, key, **options)
    bits = options.get("bits", BITS)
    return docs.withColumn(out, scorer(docs.sparkSession, weights, bits)(F.col(text)))


def held_out(key="doc_id"):
    """True for ids that never teach: crc32 of the id's text divisible by 5; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Result of the registered query."""
    teaching = labels.where(~held_out())
    scored = score_quality(docs.select("doc_id", "text"), teaching)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, with the same columns."""
    weights = fit(docs, labels.where(~held_out()))
    return docs.where(scorer(docs.sparkSession, weights)(F.col("text")) >= THRESHOLD)
