"""URL filters: host rules first, link-graph propagation for every other page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.session import cut_lineage

# (action, host, path)
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
DAMPING = 0.85
ROUNDS = 20
# a host is blocked once distrust outweighs trust by more than this share of its pages
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]*)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(name, action) of the longest rule that fits the host or a domain above it and starts the path."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, domain, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name = F.when(fits, F.lit(domain + prefix)).otherwise(name)
        action = F.when(fits, F.lit(what)).otherwise(action)
    return name, action


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): links between hosts.  A relative link stays on its host; each host has at least that one.

    Pages without a host give no edges.  Links are counted on the map side, so a host with a third
    of all pages is a few rows after it.
    """
    links = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))
    found = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.concat(F.array(F.lit("")), links)).alias("to"))
    target = F.when(F.col("to").contains("://"), host_of(F.col("to"))).when(
        F.col("to").startswith("//"), host_of(F.concat(F.lit("x:"), F.col("to")))
    ).otherwise(F.col("src"))
    return (
        found.select("src", target.alias("dst")).where("src <> '' AND dst <> ''")
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) of all hosts in ``seeds`` (host, trust, distrust) and ``edges``.

    Personalised PageRank: trust starts from the trusted seeds and follows links, distrust starts
    from the blocked ones and follows links backwards.  Both directions are one join and one
    aggregation a round, and each round is written to the checkpoint folder.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("all_out"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("all_in"))
    weighed = edges.join(out, "src").join(into, "dst")
    steps = cut_lineage(
        weighed.select(F.explode(F.array(
            F.struct(F.col("src").alias("at"), F.col("dst").alias("to"), (F.col("n") / F.col("all_out")).alias("forward"), F.lit(0.0).alias("back")),
            F.struct(F.col("dst").alias("at"), F.col("src").alias("to"), F.lit(0.0).alias("forward"), (F.col("n") / F.col("all_in")).alias("back")),
        )).alias("s")).select("s.*").groupBy("at", "to").agg(F.sum("forward").alias("forward"), F.sum("back").alias("back"))
    )
    linked = steps.select(F.col("to").alias("host")).distinct()
    start = cut_lineage(
        linked.join(seeds, "host", "full").select(
            "host", *[((1 - damping) * F.coalesce(c, F.lit(0.0))).alias(c) for c in ("trust", "distrust")]
        )
    )
    ranks = start
    for _ in range(rounds):
        moved = (
            steps.join(ranks, steps["at"] == ranks["host"]).groupBy("to")
            .agg(F.sum(F.col("forward") * F.col("trust")).alias("t"), F.sum(F.col("back") * F.col("distrust")).alias("d"))
        )
        ranks = cut_lineage(
            start.join(moved, start["host"] == moved["to"], "left").select(
                "host", (F.col("trust") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
                (F.col("distrust") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
            )
        )
    return ranks


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url",
          html: str = "html", rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(key, host, path, rule, verdict) of every page.

    A rule decides the pages it fits.  Its pages are also the seeds of their hosts: an allowed page
    is one unit of trust, a blocked one a unit of distrust.  Any other page is blocked if the
    distrust that reaches its host exceeds the trust by more than ``threshold`` of the host's
    pages.  NULL urls and those without ``://`` have an empty host, no rule and are allowed.
    Repeated rows are judged alike; an empty table gives an empty result.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    named = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    ruled = cut_lineage(named.withColumn("rule", rule).withColumn("action", action))
    hosts = cut_lineage(
        ruled.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("action") == "allow").cast("double").alias("trust"),
            F.count_if(F.col("action") == "block").cast("double").alias("distrust"),
        )
    )
    ranks = propagate(cut_lineage(host_edges(pages, url, html)), hosts.select("host", "trust", "distrust"), rounds)
    blocked = (
        hosts.select("host", "pages").join(ranks, "host")
        .where(F.col("distrust") - F.col("trust") > threshold * F.col("pages")).select(F.col("host").alias("bad"))
    )
    met = ruled.join(blocked, ruled["host"] == blocked["bad"], "left")
    verdict = F.coalesce("action", F.when(F.col("bad").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return met.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"))


def op8(pages: DataFrame) -> DataFrame:
    """Result of the registered query."""
    return judge(pages)


def _sql() -> str:
    host = "translate(regexp_extract(coalesce({0}, ''), '^.*?://([^/?#]*)', 1, 's'), '%s', '%s')" % (UPPER, LOWER)
    rounds = []
    for i in range(1, ROUNDS + 1):
        rounds.append(f"""r{i} AS MATERIALIZED (
  SELECT s.host, s.trust + {DAMPING} * coalesce(m.t, 0) AS trust, s.distrust + {DAMPING} * coalesce(m.d, 0) AS distrust
  FROM r0 s LEFT JOIN (
    SELECT w.dst AS host, sum(w.forward * r.trust) AS t, sum(w.back * r.distrust) AS d
    FROM w JOIN r{i - 1} r ON w.src = r.host GROUP BY w.dst
  ) m ON s.host = m.host
)""")
    fits = [
        f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '{p}') THEN '{{}}'"
        for _, d, p in sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    ]
    ordered = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    rule = "CASE " + " ".join(f.format(d + p) for f, (_, d, p) in zip(fits, ordered)) + " END"
    action = "CASE " + " ".join(f.format(a) for f, (a, _, _) in zip(fits, ordered)) + " END"
    link = LINK.removeprefix("(?i)").replace("'", "''")
    return f"""
WITH n AS MATERIALIZED (
  SELECT page_id, html, {host.format('url')} AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), p AS MATERIALIZED (
  SELECT page_id, host, path, {rule} AS rule, {action} AS action FROM n
), h AS MATERIALIZED (
  SELECT host, count(*) AS pages, count(*) FILTER (action = 'allow') AS trust, count(*) FILTER (action = 'block') AS distrust
  FROM p WHERE host <> '' GROUP BY host
), l AS (
  SELECT host AS src, unnest(list_concat([''], regexp_extract_all(coalesce(html, ''), '{link}', 1, 'i'))) AS link FROM n
), e AS MATERIALIZED (
  SELECT src, dst, count(*) AS n FROM (
    SELECT src, CASE WHEN contains(link, '://') THEN {host.format('link')}
                     WHEN starts_with(link, '//') THEN {host.format("('x:' || link)")} ELSE src END AS dst FROM l
  ) WHERE src <> '' AND dst <> '' GROUP BY ALL
), w AS MATERIALIZED (
  SELECT src, dst, sum(forward) AS forward, sum(back) AS back FROM (
    SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS forward, 0 AS back FROM e
    UNION ALL SELECT dst, src, 0, n / sum(n) OVER (PARTITION BY dst) FROM e
  ) GROUP BY ALL
), r0 AS MATERIALIZED (
  SELECT coalesce(x.host, h.host) AS host, {1 - DAMPING} * coalesce(h.trust, 0) AS trust, {1 - DAMPING} * coalesce(h.distrust, 0) AS distrust
  FROM (SELECT DISTINCT dst AS host FROM w) x FULL JOIN h ON x.host = h.host
), {", ".join(rounds)}
SELECT p.page_id, p.host, p.path, p.rule,
       coalesce(p.action, CASE WHEN b.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN (
  SELECT h.host FROM h JOIN r{ROUNDS} r ON h.host = r.host WHERE r.distrust - r.trust > {THRESHOLD} * h.pages
) b ON p.host = b.host
"""


OP8_SQL = _sql()
