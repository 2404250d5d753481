"""First-match joins: which source page does an item belong to?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide.operators.joins import unique_left_join

# length of the pieces that texts are met by
GRAM = 6
# bits of a piece's hash beside its count
MARK_BITS = 24
MARK = (1 << MARK_BITS) - 1


def _pieces(text: Column, length: Column | int) -> Column:
    """Every substring of that length."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    size = F.lit(length) if isinstance(length, int) else length
    return F.when(
        F.length(text) >= length, F.transform(starts, lambda i: F.substring(text, i, size))
    ).otherwise(F.array().cast("array<string>"))


def _rarest_piece(needles: DataFrame) -> DataFrame:
    """(needle, piece): of the pieces of a needle one that fewest needles have.

    Pieces that every needle has meet in one task, so rows are neither sorted for their counts nor
    for the smallest of them: counts are looked up in a hash table of distinct pieces, and a needle
    keeps one number, made of a count and a hash that tells which piece it was.
    """
    every = F.array_distinct(_pieces(F.col("needle"), F.least(F.length("needle"), F.lit(GRAM))))

    def mark(piece: Column) -> Column:
        return F.xxhash64(piece).bitwiseAND(F.lit(MARK))

    pieces = needles.select("needle", F.explode(every).alias("piece"))
    often = pieces.groupBy("piece").agg(F.count("*").alias("n"))
    ranked = pieces.join(often.hint("shuffle_hash"), "piece").select(
        "needle", F.shiftleft("n", MARK_BITS).bitwiseOR(mark(F.col("piece"))).alias("rank"))
    best = ranked.groupBy("needle").agg(F.min("rank").bitwiseAND(F.lit(MARK)).alias("best"))
    # should two pieces of a needle share a hash, either will do: every needle is looked for by a piece it has
    return best.select("needle", F.get(F.filter(every, lambda p: mark(p) == F.col("best")), F.lit(0)).alias("piece"))


def _containing(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(text, needle) of distinct texts and the needles they contain.

    A needle is looked for where its rarest piece occurs, which is an equi-join; the pairs that
    meet there are tested.  Texts give as many pieces as they have characters, at most GRAM times.
    """
    keyed = _rarest_piece(needles)
    # pieces have at most GRAM different lengths
    lengths = sorted(r["n"] for r in keyed.select(F.length("piece").alias("n")).distinct().collect())
    if not lengths:
        return texts.select("text", F.col("text").alias("needle")).where("false")
    every = F.array_distinct(F.concat(*[_pieces(F.col("text"), n) for n in lengths]))
    return (
        texts.select("text", F.explode(every).alias("piece")).join(keyed, "piece")
        .where(F.col("text").contains(F.col("needle"))).select("text", "needle")
    )


def _keyed(pages: DataFrame, page: Column, seq: str) -> DataFrame:
    """Each page text with its first place."""
    keyed = pages.select(page.alias("page"), F.col(seq).cast("bigint").alias("seq")).where("page <> ''")
    return keyed.groupBy("page").agg(F.min("seq").alias("seq"))


def _as(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name))


def with_first_overlap(items: DataFrame, item: str, pages: DataFrame, page: Column, seq: str, out: str) -> DataFrame:
    """Add the ``seq`` of the first page that contains the item's text or is contained in it.

    Empty and NULL items and pages match nothing.  Each distinct item text is matched once.
    """
    texts = items.select(F.col(item).alias("item")).where("item <> ''").distinct()
    first_of = _keyed(pages, page, seq)
    inside_item = _containing(_as(texts, "item", "text"), _as(first_of, "page", "needle")).select(
        F.col("text").alias("item"), F.col("needle").alias("page"))
    inside_page = _containing(_as(first_of, "page", "text"), _as(texts, "item", "needle")).select(
        F.col("needle").alias("item"), F.col("text").alias("page"))
    # a page may be found in most items, so the pairs are not sorted to meet its place
    first = inside_item.unionByName(inside_page).join(first_of.hint("shuffle_hash"), "page").groupBy("item").agg(F.min("seq").alias(out))
    return unique_left_join(items, first.withColumnRenamed("item", item), [item])


def with_first_holder(items: DataFrame, name: str, pages: DataFrame, page: Column, seq: str, out: str) -> DataFrame:
    """Add the ``seq`` of the first page whose text contains the item's (non-empty) name."""
    names = items.select(F.col(name).alias("needle")).where("needle <> ''").distinct()
    first_of = _keyed(pages, page, seq)
    held = _containing(_as(first_of, "page", "text"), names).join(first_of.withColumnRenamed("page", "text"), "text")
    first = held.groupBy(F.col("needle").alias(name)).agg(F.min("seq").alias(out))
    return unique_left_join(items, first, [name])


def assign_pages(items: DataFrame, pages: DataFrame, asked_url: str = "asked_url", page_name: str = "page_name",
                 url: str = "url", seq: str = "page_seq", unmatched: str = "quarantine") -> DataFrame:
    """Add ``page_seq`` and ``matched_by`` (url, name, default or NULL) to each item.

    ``unmatched="first"`` credits items without a match, and items without any asked URL, to the
    first page; the default leaves them unassigned.
    """
    bare = F.lower(F.regexp_replace(url, "/+$", ""))
    work = items.withColumns({
        "_asked": F.nullif(F.lower(F.col(asked_url)), F.lit("")), "_name": F.lower(F.col(page_name)),
    })
    work = with_first_overlap(work, "_asked", pages, bare, seq, "_by_url")
    work = with_first_holder(work, "_name", pages, F.lower(url), seq, "_by_name")
    found = F.coalesce("_by_url", "_by_name")
    how = F.when(F.col("_by_url").isNotNull(), F.lit("url")).when(F.col("_by_name").isNotNull(), F.lit("name"))
    if unmatched == "first":
        first = pages.agg(F.min(seq)).first()[0]
        no_url = F.col("_asked").isNull()
        found = F.when(no_url, F.lit(first)).otherwise(F.coalesce(found, F.lit(first))).cast("bigint")
        how = F.when(no_url, F.lit("url")).otherwise(F.coalesce(how, F.lit("default")))
    return work.select(*items.columns, found.alias(seq), how.alias("matched_by"))
