"""Typed values from dirty sheet cells; every reader has a matching reject reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtide.functions.text import strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _number(cell: Column, strip_commas: bool) -> Column:
    text = strip(cell.cast("string"))
    if strip_commas:
        text = F.replace(text, F.lit(","), F.lit(""))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def optional_int(cell: Column, strip_commas: bool = True) -> Column:
    """A whole number >= 0, or NULL for blank, text-only and rejected cells."""
    number = _number(cell, strip_commas)
    return F.when((number >= 0) & (number == F.floor(number)), number.try_cast("bigint"))


def optional_int_reject(cell: Column, strip_commas: bool = True) -> Column:
    """Why the cell cannot be loaded as a count; NULL when it can (unreadable text counts as blank)."""
    number = _number(cell, strip_commas)
    return F.when(number < 0, F.lit("negative")).when(number != F.floor(number), F.lit("fractional"))


def optional_float(cell: Column) -> Column:
    number = _number(cell, False)
    return F.when(number >= 0, number)


def optional_float_reject(cell: Column) -> Column:
    number = _number(cell, False)
    text = strip(cell.cast("string"))
    return (
        F.when(cell.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(number.isNull(), F.lit("not_a_number"))
        .when(number < 0, F.lit("negative"))
    )


def unit_weight(cell: Column) -> Column:
    number = _number(cell, False)
    return F.when(number.between(0, 1), number)


def unit_weight_reject(cell: Column) -> Column:
    number = _number(cell, False)
    return F.when(number.isNull(), F.lit("not_a_number")).when(~number.between(0, 1), F.lit("out_of_range"))


def required_text(cell: Column, longest: int) -> Column:
    text = strip(cell.cast("string"))
    return F.when((text != "") & (F.length(text) <= longest), text)


def required_text_reject(cell: Column, longest: int) -> Column:
    text = strip(cell.cast("string"))
    return (
        F.when(cell.isNull(), F.lit("missing"))
        .when(text == "", F.lit("blank"))
        .when(F.length(text) > longest, F.lit("too_long"))
    )


def header_year(cell: Column) -> Column:
    """Year from a header such as ``2024`` or ``2024.0``."""
    return _number(cell, False).try_cast("int")
