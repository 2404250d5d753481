"""Benchmark decontamination with spaced seeds, in DataFrame operations only."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.llm.words import bound, hashed, words_column
from railtide.session import cut_lineage

# an overlap is a stretch of so many tokens, of which so large a share is equal place by place
WINDOW = 15
SHARE = 0.8
# By the length of an overlap, 1: the token counts, 0: any token will do.  Masks of which one at least, somewhere in the overlap, looks at equal
# tokens only, whichever of its tokens differ as SHARE allows (one of 5 to 9, two of 10 to 14, three
# of 15).  Found by search, tested by enumeration.
SEEDS = {
    5: ("1111", "11011", "11101", "10111"),
    6: ("1111", "110011"),
    7: ("11111", "111011", "1101101"),
    8: ("111111", "11110011", "11001111"),
    9: ("1101111", "11111001"),
    10: ("111011", "11010011", "1100001011"),
    11: ("1101111", "111100011", "1100011011"),
    12: ("11101011", "1100100111", "110000101011"),
    13: ("11101011", "1100100111", "110000101011"),
    14: ("111001011", "11001000001011"),
    15: ("1101111", "11100010011", "10001101011"),
}
# a benchmark item of fewer words occurs in ordinary text: it is looked for as a whole text only
LEAST_WORDS = 5
# seeds of the benchmark may be broadcast up to this many rows, about 60 MB
BROADCAST_SEEDS = 500_000


def _masks(lengths: list[int]) -> dict[str, list[int]]:
    """Masks for overlaps of the given lengths, each with those it is for."""
    out = {}
    for n in sorted(lengths):
        for mask in SEEDS[n]:
            out.setdefault(mask, []).append(n)
    return out


def seed_hashes(tokens: Column, mask: str, number: int) -> Column:
    """Hash of the looked-at tokens at every place the mask fits; ``tokens`` are word hashes."""
    seen = [i for i, c in enumerate(mask) if c == "1"]
    places = F.sequence(F.lit(0), F.size(tokens) - len(mask))
    one = F.transform(places, lambda at: F.xxhash64(F.lit(number), *[F.get(tokens, at + i) for i in seen]))
    return F.when(F.size(tokens) >= len(mask), one).otherwise(F.array().cast("array<bigint>"))


def _seeds(df: DataFrame, keep: list[str], tokens: Column, masks: dict[str, list[int]], place: str, items: bool = False) -> DataFrame:
    """One row per seed: the columns of ``keep``, the seed's hash and its place in ``tokens``.

    Of ``items`` only the masks for the item's length are taken, of texts all.
    """
    def listed(held: Column) -> Column:
        window = F.least(F.size(held), F.lit(WINDOW))
        taken = [window.isin(lengths) if items else F.lit(True) for lengths in masks.values()]
        counts = [F.when(t, F.greatest(F.size(held) - len(m) + 1, F.lit(0))).otherwise(F.lit(0)) for m, t in zip(masks, taken)]
        before = [functools.reduce(lambda a, b: a + b, counts[:i], F.lit(0)) for i in range(len(masks) + 1)]
        hashes = [
            F.when(t, seed_hashes(held, m, i)).otherwise(F.array().cast("array<bigint>")) for i, (m, t) in enumerate(zip(masks, taken))
        ]
        return F.struct(F.array(*before).alias("starts"), F.concat(*hashes).alias("hashes"))

    made = df.select(*keep, bound(tokens, listed).alias("s")).select(*keep, F.col("s.starts").alias("starts"), F.posexplode("s.hashes").alias("n", "seed"))
    at = F.col("n")
    for i in range(1, len(masks)):
        start = F.get("starts", F.lit(i))
        at = F.when(F.col("n") >= start, F.col("n") - start).otherwise(at)
    return made.select(*keep, "seed", at.alias(place))


def benchmark_items(benchmark: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """(item, tokens) of items with words; equal items are one, under the smallest key."""
    tokens = hashed(words_column(F.col(text)))
    return (
        benchmark.select(F.col(key).alias("item"), tokens.alias("tokens")).where(F.size("tokens") > 0)
        .groupBy("tokens").agg(F.min("item").alias("item")).select("item", "tokens")
    )


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _verified(tokens: Column, found: Column) -> Column:
    """Of the candidates (item, shift, tokens of the item): those with an overlap, as (item, first, last, equal)."""
    def check(c: Column, held: Column) -> Column:
        item, shift = c["tokens"], c["shift"]
        window = F.least(F.size(item), F.lit(WINDOW))

        def judge(equal: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(equal) - window)
            enough = F.filter(places, lambda j: F.aggregate(F.slice(equal, j + 1, window), F.lit(0), lambda a, e: a + e) >= F.ceil(SHARE * window))
            return bound(enough, lambda good: F.struct(
                c["item"].alias("item"), (shift + F.array_min(good)).alias("first"),
                (shift + F.array_max(good) + window - 1).alias("last"),
                (F.aggregate(equal, F.lit(0), lambda a, e: a + e) / F.size(equal)).alias("equal"),
            ))

        there = F.transform(item, lambda token, j: F.coalesce(
            F.get(held, F.when(j + shift >= 0, j + shift)) == token, F.lit(False)).cast("int"))
        return bound(there, judge)

    return F.filter(bound(tokens, lambda held: F.transform(found, lambda c: check(c, held))), lambda r: r["first"].isNotNull())


def _matched(docs: DataFrame, benchmark: DataFrame, text: str) -> DataFrame:
    """(row, overlaps): each row of ``docs`` as one struct, so that no column of its can clash."""
    items = cut_lineage(benchmark_items(benchmark))
    long = items.where(F.size("tokens") >= LEAST_WORDS)
    lengths = [r["n"] for r in long.select(F.least(F.size("tokens"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    masks = _masks(lengths or [WINDOW])
    seeds = cut_lineage(_seeds(long, ["item"], F.col("tokens"), masks, "item_at", items=True))
    asked = F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds
    texts = docs.select(_digest(text).alias("digest"), F.col(text).alias("text"))
    candidates = (
        _seeds(texts, ["digest"], hashed(words_column(F.col("text"))), masks, "at").join(asked, "seed")
        .select("digest", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    )
    short = texts.select("digest", hashed(words_column(F.col("text"))).alias("tokens")).where(F.size("tokens").between(1, LEAST_WORDS - 1))
    whole = short.distinct().join(items.where(F.size("tokens") < LEAST_WORDS), "tokens").select("digest", "item", F.lit(0).alias("shift"))
    listed = cut_lineage(
        candidates.unionByName(whole).join(items, "item").groupBy("digest")
        .agg(F.collect_list(F.struct("item", "shift", "tokens")).alias("found"))
    )
    held = docs.select(F.struct("*").alias("row"), _digest(text).alias("digest"))
    verified = _verified(hashed(words_column(F.col("row")[text])), F.col("found"))
    return held.join(listed, "digest", "left").select("row", F.when(F.col("found").isNotNull(), verified).alias("overlaps"))


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "overlaps") -> DataFrame:
    """``docs`` with an array of (item, first, last, equal) in ``out``, token places in the text.

    Seeds of texts meet seeds of the benchmark in one equi-join; hits on one diagonal of a text and
    an item are one candidate.  Candidates are few and come back to their texts by digest, where
    the tokens around them are compared place by place: an overlap is WINDOW tokens (or the whole
    item, if shorter) of which SHARE are equal.  Every place of every text is a seed, and every
    overlap holds one that no substitution touches.  Items of fewer than LEAST_WORDS words overlap
    a text that has the same words and no others.

    NULL and empty texts and texts without words overlap nothing, nor do such items.  Repeated rows
    stay and are judged alike; a column named ``out`` is replaced.  Empty tables are no special case.
    """
    return _matched(docs.drop(out), benchmark, text).select("row.*", F.col("overlaps").alias(out))


def _is_hit() -> Column:
    return F.coalesce(F.size("overlaps") > 0, F.lit(False))


def op2(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Result of the registered query: one row per document.

    NULL and empty texts overlap nothing.  ``item_id`` is the smallest item that overlaps,
    ``equal`` the largest share of an item's tokens found in place.
    """
    found = _matched(docs.select("doc_id", "text"), benchmark, "text").select("row.doc_id", "overlaps")
    items = F.array_distinct(F.transform("overlaps", lambda r: r["item"]))
    return found.select(
        "doc_id", _is_hit().alias("contaminated"),
        F.when(_is_hit(), F.size(items)).otherwise(F.lit(0)).cast("bigint").alias("n_items"),
        F.when(_is_hit(), F.array_min(items)).alias("item_id"),
        F.when(_is_hit(), F.array_max(F.transform("overlaps", lambda r: r["equal"]))).otherwise(F.lit(0.0)).alias("equal"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` without an overlap, with the same columns, whatever their names; see ``overlaps``."""
    return _matched(docs, benchmark, "text").where(~_is_hit()).select("row.*")


def _sql() -> str:
    """Without seeds: what SHARE accepts leaves two equal tokens in a row in a window of 5 and three in
    a longer one, so texts and items meet on those.
    """
    def runs(table: str, key: str, place: str, which: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {key}, {n} AS run, p AS {place}, array_to_string(words[p + 1:p + {n}], ' ') AS seed FROM ("
            f"SELECT {key}, words, unnest(range(0, len(words) - {n - 1})) AS p FROM {table} WHERE {which.format(size)})"
            for n, size in ((2, f"len(i.words) = {LEAST_WORDS}"), (3, f"len(i.words) > {LEAST_WORDS}"))
        )

    words = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
WITH i AS MATERIALIZED (
  SELECT min(item_id) AS item_id, words FROM (SELECT item_id, {words} AS words FROM benchmark)
  WHERE len(words) > 0 GROUP BY words
), d AS MATERIALIZED (SELECT doc_id, {words} AS words FROM documents
), ds AS ({runs('d', 'doc_id', 'doc_at', 'EXISTS (SELECT 1 FROM i WHERE {})')}
), bs AS ({runs('i', 'item_id', 'item_at', '{}')}
), c AS (
  SELECT DISTINCT doc_id, item_id, doc_at - item_at AS shift FROM ds JOIN bs USING (run, seed)
  UNION ALL SELECT doc_id, item_id, 0 FROM d JOIN i ON d.words = i.words WHERE len(i.words) < {LEAST_WORDS}
), e AS (
  SELECT doc_id, item_id, shift, least(len(i.words), {WINDOW}) AS w, len(i.words) AS n,
         list_transform(range(0, len(i.words)), lambda j: CASE WHEN j + shift >= 0 AND coalesce(d.words[j + shift + 1] = i.words[j + 1], false) THEN 1 ELSE 0 END) AS eq
  FROM c JOIN d USING (doc_id) JOIN i USING (item_id)
), g AS (
  SELECT doc_id, item_id, list_sum(eq) / n AS equal,
         list_max(list_transform(range(0, n - w + 1), lambda j: list_sum(eq[j + 1:j + w]))) >= ceil({SHARE} * w) AS good
  FROM e
), r AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, min(item_id) AS item_id, max(equal) AS equal
  FROM g WHERE good GROUP BY doc_id
)
SELECT d.doc_id, r.doc_id IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, item_id, coalesce(equal, 0.0) AS equal
FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""


OP2_SQL = _sql()
