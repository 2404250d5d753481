"""Sheet labels: identifiers, service periods, months and service dates."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtide import vocab
from railtide.functions.text import SPACE, let, strip


def lookup(key: Column, table: Mapping, default: Column | None = None) -> Column:
    """Value of a small fixed table; ``default`` (or NULL) for keys it does not hold."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(found, default) if default is not None else found


def identifier(cell: Column, aliases: Mapping[str, str] = vocab.STATION_ALIASES) -> Column:
    """``Betty Go-Belmonte`` -> ``betty_go_belmonte``, then the alias table."""
    name = F.btrim(F.regexp_replace(F.lower(cell), "[^a-z0-9]+", "_"), F.lit("_"))
    return let(name, lambda n: lookup(n, aliases, n)) if aliases else name


def _fuzzy_period(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for label, tokens in reversed(vocab.FUZZY_PERIODS):
        hit = functools.reduce(lambda a, b: a & b, [text.contains(token) for token in tokens])
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def period_label(cell: Column) -> Column:
    """Service period named somewhere in a cell; the tests run in order and look for substrings."""
    return let(F.lower(F.regexp_replace(strip(cell), rf"{SPACE}+", " ")), _fuzzy_period)


def row_period_label(cell: Column) -> Column:
    """Service period of a summary row: exact spellings, clock ranges, then ``period_label``."""
    def chain(text: Column) -> Column:
        out = F.when(text.rlike(r"^\d{1,2}:\d{2}-\d{1,2}:\d{2}$"), strip(cell)).otherwise(period_label(cell))
        for label, spellings in reversed(vocab.EXACT_PERIODS):
            out = F.when(text.isin(*spellings), F.lit(label)).otherwise(out)
        return out

    return let(F.lower(F.regexp_replace(strip(cell), rf"{SPACE}+", "")), chain)


def period_rank(label: Column) -> Column:
    """Sort position of a period: named ones first, clock ranges by start, others last."""
    clock = F.regexp_extract(label, r"^(\d{1,2}):(\d{2})-", 1)
    minute = F.regexp_extract(label, r"^(\d{1,2}):(\d{2})-", 2)
    start = F.when(
        clock != "", F.lit(vocab.CLOCK_PERIOD_BASE) + clock.try_cast("int") * 60 + minute.try_cast("int")
    )
    return F.coalesce(lookup(label, vocab.PERIOD_RANK), start, F.lit(vocab.UNKNOWN_PERIOD_RANK))


def month_number(name: Column) -> Column:
    return lookup(F.lower(strip(name)), vocab.MONTHS)


def file_month(stem: Column) -> Column:
    return month_number(F.nullif(F.regexp_extract(stem, vocab.FILE_PERIOD, 1), F.lit("")))


def file_year(stem: Column) -> Column:
    return F.regexp_extract(stem, vocab.FILE_PERIOD, 2).try_cast("int")


def _month_day(cell: Column) -> Column:
    """``month-day`` of a cell that has the shape of a date, else NULL.

    Reads ``1-Jan``, ``January 5``, ``2023-01-05 00:00:00`` and ``1/15/2023``.
    """
    text = strip(cell)
    day_name = r"^(\d{1,2})[-/ .]+([A-Za-z]{3,9})\b"
    name_day = r"^([A-Za-z]{3,9})[-/ .]+(\d{1,2})\b"
    iso = r"^\d{4}-(\d{1,2})-(\d{1,2})\b"
    slashed = r"^(\d{1,2})/(\d{1,2})(?:/\d{2,4})?$"

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    return (
        F.when(text.rlike(day_name), F.concat(month_number(part(day_name, 2)), F.lit("-"), part(day_name, 1)))
        .when(text.rlike(name_day), F.concat(month_number(part(name_day, 1)), F.lit("-"), part(name_day, 2)))
        .when(text.rlike(iso), F.concat(part(iso, 1), F.lit("-"), part(iso, 2)))
        .when(text.rlike(slashed), F.concat(part(slashed, 1), F.lit("-"), part(slashed, 2)))
    )


def service_date(cell: Column, year: Column) -> Column:
    """Day and month of a cell in the sheet's year; NULL for anything else, 29 Feb included."""
    return F.concat(year.cast("int"), F.lit("-"), _month_day(cell)).try_cast("date")


def service_date_reject(cell: Column, year: Column) -> Column:
    """``bad_date`` for a cell that has the shape of a date but is none in that year."""
    return F.when(_month_day(cell).isNotNull() & service_date(cell, year).isNull(), F.lit("bad_date"))


def acronym(name: Column, table: Mapping[str, str] = vocab.ACRONYMS) -> Column:
    """Known short form, else the upper-case initials of the words that start with a letter."""
    words = F.filter(F.split(strip(name), rf"{SPACE}+"), lambda w: w.rlike(r"^\p{L}"))
    initials = F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), "")
    return lookup(F.lower(strip(name)), table, initials) if table else initials
