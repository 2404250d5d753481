"""Nested payloads: parallel arrays to rows, media lists, captions and classifier answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions import rules
from railtide.operators.ids import padded_id

ANSWER_SCHEMA = (
    "category string, event_name string, event_date string, event_code string, "
    "is_cancellation boolean, cancellation_target_code string"
)


def forecast_slots(df: DataFrame, arrays: dict[str, str], first: str, days: int = vocab.FORECAST_DAYS) -> DataFrame:
    """One row per day after today: entry i+1 of each array becomes slot i, at most ``days`` of them.

    ``arrays`` maps array columns to output names, ``first`` is the one that sets the length.
    """
    width = F.least(F.lit(days), F.greatest(F.size(first) - 1, F.lit(0)))
    zipped = F.arrays_zip(*[F.slice(F.col(a), 2, F.greatest(width, F.lit(0))).alias(a) for a in arrays])
    zipped = F.slice(zipped, 1, width)
    kept = [c for c in df.columns if c not in arrays]
    return df.select(*kept, F.posexplode(zipped).alias("_pos", "_day")).select(
        *kept, (F.col("_pos") + 1).alias("slot"), *[F.col("_day")[a].alias(name) for a, name in arrays.items()]
    )


def slot_id(code: Column, slot: Column, prefix: str = "FCT") -> Column:
    return padded_id(F.concat_ws("-", F.lit(prefix), code), slot)


def caption(text: Column, reshared: Column, shared: Column, attached: Column) -> Column:
    """First text that is not empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (text, reshared, shared, attached)], F.lit(""))


def media_uri(media: Column, link_fallback: bool = True) -> Column:
    """Image address of one media entry: full photo, thumbnail, then a link that is no photo page."""
    link = F.nullif(media["url"], F.lit(""))
    options = [F.nullif(media["photo_image"]["uri"], F.lit("")), F.nullif(media["thumbnail"], F.lit(""))]
    if link_fallback:
        options.append(F.when(~link.contains(vocab.PHOTO_PAGE_MARK), link))
    return F.coalesce(*options)


def media_uris(media: Column) -> Column:
    """Image addresses of a media array, entries without one left out."""
    return F.array_compact(F.transform(F.coalesce(media, F.array().cast(MEDIA_TYPE)), lambda m: media_uri(m)))


MEDIA_TYPE = "array<struct<photo_image:struct<uri:string>,thumbnail:string,url:string,ocrText:string>>"


def parse_answer(text: Column) -> Column:
    """Classifier answer as a struct; words for nothing become NULL, unknown categories too."""
    answer = F.from_json(text, ANSWER_SCHEMA, {"mode": "PERMISSIVE"})
    names = ["event_name", "event_date", "event_code", "cancellation_target_code"]
    return F.struct(
        rules.allowed_category(rules.null_words(answer["category"])).alias("category"),
        *[rules.null_words(answer[n]).alias(n) for n in names],
        F.coalesce(answer["is_cancellation"], F.lit(False)).alias("is_cancellation"),
    )
