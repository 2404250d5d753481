import pytest
from pyspark.sql import functions as F

from railtide.llm import linkgraph

PAGE = "page_id bigint, url string, html string"


def slow_rank(edges, seeds, backwards, rounds=20, damping=0.85):
    hosts = {h for e in edges for h in e} | set(seeds)
    if backwards:
        edges = {(b, a): n for (a, b), n in edges.items()}
    rank = {h: (1 - damping) * seeds.get(h, 0) for h in hosts}
    start = dict(rank)
    for _ in range(rounds):
        moved = dict.fromkeys(hosts, 0.0)
        for (a, b), n in edges.items():
            moved[b] += rank[a] * n / sum(m for (x, _), m in edges.items() if x == a)
        rank = {h: start[h] + damping * moved[h] for h in hosts}
    return rank


def test_propagation_against_plain_loops(spark):
    edges = {("a", "a"): 2, ("a", "b"): 1, ("b", "c"): 3, ("c", "a"): 1, ("d", "c"): 5, ("d", "d"): 1, ("e", "d"): 1}
    trust, distrust = {"a": 3.0, "f": 1.0}, {"c": 2.0}
    frame = spark.createDataFrame([(*k, n) for k, n in edges.items()], "src string, dst string, n bigint")
    seeds = spark.createDataFrame(
        [(h, trust.get(h, 0.0), distrust.get(h, 0.0)) for h in {*trust, *distrust}], "host string, trust double, distrust double"
    )
    got = {r["host"]: (r["trust"], r["distrust"]) for r in linkgraph.propagate(frame, seeds).collect()}
    forward, back = slow_rank(edges, trust, False), slow_rank(edges, distrust | {'f': 0.0}, True)
    assert got.keys() == forward.keys()
    assert all(got[h] == pytest.approx((forward[h], back[h])) for h in got)


CASES = [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"),
    ("https://example.net/de/", "example.net", "/de/", "net/"),
    ("https://notexample.net/en/", "notexample.net", "/en/", "net/"),
    ("x://org/fr/1", "org", "/fr/1", "org/fr/"), ("x://borg/fr/1", "borg", "/fr/1", None),
    ("http://net", "net", "", None), ("http://h.net?x=http://y.org/", "h.net", "", None), ("http://h.net#/a", "h.net", "", None),
    ("nothing", "", "", None), ("", "", "", None), (None, "", "", None), ("://ÉcoLE.org/fr/é b\nc?d", "École.org", "/fr/é b\nc", "org/fr/"),
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, c[0], None) for i, c in enumerate(CASES)], PAGE)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in linkgraph.judge(pages, rounds=2).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}


def test_links_carry_distrust_backwards_and_trust_forwards(spark):
    pages = [
        (1, "http://bad.net/x", None), (2, "http://fan.com/1", '<a href="http://bad.net/y">x</a>'),
        (3, "http://fan.com/2", "<a class=q HREF='//bad.net/z'>x</a>"), (4, "http://good.org/fr/", '<a href="http://seen.com/">s</a>'),
        (5, "http://seen.com/1", '<a href="http://bad.net/">x</a><a href="/home">h</a>'), (6, None, None), (6, None, None),
    ]
    got = linkgraph.judge(spark.createDataFrame(pages, PAGE).withColumn("host", F.lit("clash")), threshold=0.2).collect()
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "allow", 5: verdict[5], 6: "allow"}
    assert len(got) == 7


def test_empty_table(spark):
    assert linkgraph.op8(spark.createDataFrame([], PAGE)).collect() == []
