"""Ages, offsets, staleness and readable dates.  ``now`` is always passed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions.text import strip

DAY_MICROS = 86_400_000_000
ISO_DATE = r"(\d{4}-\d{2}-\d{2})"


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def days_between(now: Column, then: Column) -> Column:
    return (micros(now) - micros(then)) / F.lit(float(DAY_MICROS))


def post_time(iso: Column, epoch_seconds: Column) -> Column:
    """ISO text if there is any, even when it cannot be read; else epoch seconds."""
    has_iso = F.coalesce(iso, F.lit("")) != ""
    from_epoch = F.when(epoch_seconds != 0, F.timestamp_micros((epoch_seconds * 1_000_000).cast("bigint")))
    return F.when(has_iso, F.try_to_timestamp(iso)).otherwise(from_epoch)


def age_days(now: Column, ts: Column) -> Column:
    """Days since ``ts``, never below zero; NULL when the time is unknown."""
    return F.when(ts.isNotNull(), F.greatest(F.lit(0.0), days_between(now, ts)))


def within_age(age: Column, max_days) -> Column:
    """Keep young rows and rows of unknown age."""
    limit = max_days if isinstance(max_days, Column) else F.lit(float(max_days))
    return age.isNull() | (age <= limit)


def post_date(now: Column, ts: Column) -> Column:
    """Time of the post; unknown and future times count as now."""
    return F.least(F.coalesce(ts.cast("timestamp"), now), now)


def is_past_event(event_date: Column, now: Column, days: int = vocab.PAST_EVENT_DAYS) -> Column:
    """True if the first date named in the text lies more than ``days`` whole days back."""
    named = F.regexp_extract(event_date, ISO_DATE, 1).try_cast("date")
    whole = F.floor(days_between(now, named))
    return F.coalesce(whole > days, F.lit(False))


def with_offset(text: Column, offset: str = vocab.LOCAL_OFFSET) -> Column:
    """Append the local offset to a time that names none."""
    return F.when(text.rlike("[+Z]"), text).otherwise(F.concat(text, F.lit(offset)))


def stale_minutes(now: Column, seen: Column) -> Column:
    return (micros(now) - micros(seen)) / F.lit(6e7)


def is_stale(now: Column, seen: Column, threshold: float = vocab.STALE_MINUTES) -> Column:
    """Missing or older than the threshold."""
    return F.coalesce(stale_minutes(now, seen) > threshold, F.lit(True))


def _pretty(day: Column) -> Column:
    return F.date_format(day, "MMMM dd, yyyy")


def pretty_event_date(text: Column) -> Column:
    """``2026-08-13`` -> ``August 13, 2026``; ranges on both ends; other text as it is."""
    value = strip(text)
    both = r"^(?i)(\d{4}-\d{2}-\d{2})\s+to\s+(\d{4}-\d{2}-\d{2})$"
    single = F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), value.try_cast("date"))
    first, last = (F.regexp_extract(value, both, g).try_cast("date") for g in (1, 2))
    return (
        F.when(text.isNull() | (text == "") | F.lower(text).isin(*vocab.UNSPECIFIED_WORDS), F.lit("Not specified"))
        .when(single.isNotNull(), _pretty(single))
        .when(first.isNotNull() & last.isNotNull(), F.concat_ws(" to ", _pretty(first), _pretty(last)))
        .otherwise(value)
    )


def event_bounds(text: Column) -> tuple[Column, Column]:
    """First and last day named in an event date, as dates."""
    named = F.regexp_extract_all(text, F.lit(ISO_DATE), 1)
    first = F.get(named, F.lit(0)).try_cast("date")
    last = F.get(named, F.size(named) - 1).try_cast("date")
    return first, last


def pretty_timestamp(text: Column) -> Column:
    """ISO time without fraction and zone, as ``August 13, 2026, 02:30 PM``; unreadable text stays."""
    head = F.regexp_replace(F.substring_index(text, ".", 1), "Z$", "")
    local = F.regexp_replace(head, r"[+-]\d{2}:\d{2}$", "")
    read = F.try_to_timestamp(local)
    return (
        F.when(text.isNull() | (text == ""), F.lit("N/A"))
        .when(read.isNotNull(), F.date_format(read, "MMMM dd, yyyy, hh:mm a"))
        .otherwise(text)
    )
