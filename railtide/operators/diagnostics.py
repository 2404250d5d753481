"""Counts and hit flags over stored HTML pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions.text import snippet

SKIPPED = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->"


def visible_text(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, SKIPPED, " "), r"<[^>]*>", " ")


def keyword_flags(text: Column, words: Sequence[str]) -> Column:
    """Map of word -> whether it occurs, case-insensitive."""
    low = F.lower(text)
    return F.create_map(*[p for w in words for p in (F.lit(w), low.contains(w.lower()))])


def keyword_matrix(df: DataFrame, text: Column, words: Sequence[str]) -> DataFrame:
    """One row per word with the number of rows it occurs in; nothing is exploded per row."""
    low = F.lower(text)
    counted = df.agg(*[F.count_if(low.contains(w.lower())).alias(f"w{i}") for i, w in enumerate(words)])
    pairs = F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"w{i}").alias("n_rows")) for i, w in enumerate(words)])
    return counted.select(F.inline(pairs))


def page_report(df: DataFrame, html: str = "html", keywords: Sequence[str] = vocab.DIAGNOSTIC_KEYWORDS,
                login_hints: Sequence[str] = vocab.LOGIN_HINTS, chars: int = 1000) -> DataFrame:
    page = F.col(html)
    work = df.withColumn("_visible", visible_text(page))
    return work.withColumns({
        "title": F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1),
        "article_blocks": F.regexp_count(page, F.lit(r"(?i)role=[\"']article[\"']")),
        "message_blocks": F.regexp_count(page, F.lit(r"(?i)data-ad-preview=[\"']message[\"']")),
        "story_blocks": F.regexp_count(page, F.lit(r"(?i)<div[^>]*class=[\"'][^\"']*(?:story|_5pbx)")),
        "feed_blocks": F.regexp_count(page, F.lit(r"data-pagelet=[\"'][^\"']*(?:FeedUnit|ProfileTimeline|Timeline)")),
        "image_tags": F.regexp_count(page, F.lit(r"(?i)<img\b")),
        "content_images": F.regexp_count(page, F.lit(r"(?i)<img\b[^>]*src=[\"'][^\"']*scontent")),
        "visible_chars": F.length("_visible"),
        "login_hits": keyword_flags(F.col("_visible"), login_hints),
        "keyword_hits": keyword_flags(F.col("_visible"), keywords),
        "snippet": snippet(F.col("_visible"), chars),
    }).drop("_visible", html)
