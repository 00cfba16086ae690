"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key widths of the ticket extracts.
VENDOR_WIDTH = 10
PLANT_WIDTH = 4
MATERIAL_WIDTH = 18
TICKET_WIDTH = 7

# Area pattern -> region code, first match wins.
REGION_LADDER = (
    ("%ASIA PAC%", "AMA-E"),
    ("%CHINA%", "GC"),
    ("%EUROPE%", "EUROPE"),
    ("%IMEA%", "AMA-W"),
    ("%LATIN%", "LA"),
    ("%NORTH%", "NA"),
)
REGION_DEFAULT = "missing"

DIGITS = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def left_padded(value: str | Column, width: int) -> Column:
    """Zero-pad to `width`; a longer value stays whole."""
    text = _col(value).cast("string")
    return F.when(F.length(text) > width, text).otherwise(F.lpad(text, width, "0"))


def pad_left_keep_right(value: str | Column, width: int) -> Column:
    """Zero-pad to `width`; a longer value keeps its rightmost characters."""
    return F.right(F.concat(F.lit("0" * width), _col(value).cast("string")), F.lit(width))


def pad_left_keep_left(value: str | Column, width: int) -> Column:
    """Zero-pad to `width`; a longer value keeps its leftmost characters."""
    return F.lpad(_col(value).cast("string"), width, "0")


def parsed_number(value: str | Column, sql_type: str) -> Column:
    """Text as a number, null when it is none.

    The pattern comes first because a failing cast costs an exception per row.
    """
    column = _col(value)
    return F.when(column.cast("string").rlike(NUMBER), column.try_cast(sql_type))


def id_number(value: str | Column) -> Column:
    """Identifier as a number, so that padding does not matter; null when not numeric."""
    column = _col(value)
    return F.when(column.cast("string").rlike(DIGITS), column.try_cast("bigint"))


def is_blank(value: str | Column) -> Column:
    """Null, empty or only spaces."""
    column = _col(value)
    return column.isNull() | (F.trim(column.cast("string")) == "")


def blank_to_null(value: str | Column) -> Column:
    column = _col(value)
    return F.when(~is_blank(column), column)


def equals_ignoring_case(value: str | Column, text: str) -> Column:
    """Case-insensitive equality that is false (not null) for a missing value."""
    return F.coalesce(F.lower(_col(value)) == text.lower(), F.lit(False))


def strip_leading_zeros(value: str | Column) -> Column:
    return F.regexp_replace(_col(value), "^0+", "")


def settled_round(value: str | Column, places: int) -> Column:
    """Half-up rounding after the noise of double arithmetic is cut off at ten decimals."""
    return F.round(_col(value).try_cast("decimal(38,10)"), places).cast("double")


def fiscal_year(date: str | Column, shift_months: int = 6) -> Column:
    """Year of the date moved ahead by half a year."""
    return F.year(F.add_months(_col(date), shift_months))


def region_code(
    area: str | Column,
    ladder: Iterable[tuple[str, str]] = REGION_LADDER,
    default: str = REGION_DEFAULT,
) -> Column:
    column = _col(area)
    expression = None
    for pattern, code in ladder:
        matched = column.like(pattern)
        expression = F.when(matched, code) if expression is None else expression.when(matched, code)
    return F.lit(default) if expression is None else expression.otherwise(default)
