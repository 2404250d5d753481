"""Keyword groups in one pass equal a scan per word."""

import random

import pytest

from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import keywords, rules
from railtide.operators import tagging

GROUPS = {"a": ["he", "she", "hers"], "b": ["his", "ushe"], "c": [], "d": ["", "zzz"], "e": ["漢", "ÉT", "a b"], "f": ["x" * 40]}


def slow(text, groups):
    return {n: None if text is None else any(w.casefold() in text for w in words) for n, words in groups.items()}


def texts(seed, count=300):
    rng = random.Random(seed)
    parts = ["u", "s", "h", "e", "r", "i", "漢", "é", "t", " ", "a b", "x" * 13, "z\x00z", "\U0001f600"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(count)] + [None, "", "x" * 100_000 + "ushers"]


def look_up(spark, values, groups):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    found = keywords.groups_found(F.col("t"), groups)
    return [r.asDict() for r in df.select("i", *[c.alias(n) for n, c in found.items()]).orderBy("i").drop("i").collect()]


def test_nested_and_overlapping_words(spark):
    values = texts(1)
    assert look_up(spark, values, GROUPS) == [slow(v, GROUPS) for v in values]


def test_more_groups_than_a_mask_holds(spark):
    groups = {f"g{i}": [chr(97 + i % 26) + chr(97 + i // 26), "xx"] for i in range(150)}
    values = ["ab ba zc", "xx", "", None, "aababacadaea"]
    assert look_up(spark, values, groups) == [slow(v, groups) for v in values]
    with pytest.raises(ValueError):
        keywords.group_mask(F.col("t"), groups)


@pytest.mark.parametrize("words", [vocab.RELEVANT_STRONG, rules.DEFAULT_GROUPS["lgu"], [f"word{i}" for i in range(20_000)]])
def test_long_lists(spark, words):
    values = [f"so {w} it" for w in words[:: max(1, len(words) // 50)]] + ["nothing here", "wor d1"]
    folded = [v.casefold() for v in values]
    assert [r["a"] for r in look_up(spark, folded, {"a": words})] == [slow(v, {"a": words})["a"] for v in folded]


def test_all_rules_read_one_mask(spark):
    df = spark.createDataFrame([(1, "Walang pasok")], "i int, t string").select("i", rules.folded(F.col("t")).alias("f"))

    def passes(out):
        plan = out._jdf.queryExecution().executedPlan().toString()
        return plan.count("mask(")

    gate = df.select("i", rules.gate_category(F.col("f")).alias("c"))
    assert passes(gate) == 1
    tagged = tagging.tag_events(df, F.col("f"))
    assert passes(tagged) == 1 and tagged.columns == ["i", "f", "event_code", "is_cancellation", "cancellation_target_code", "affects_ridership"]
