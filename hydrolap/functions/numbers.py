"""Number columns. ANSI mode raises on bad casts and on division by zero, so neither is left open."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col, strip

# Text forms of a number.
DECIMAL_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
SIGNED_NUMBER_PATTERN = r"[-+]?\d+(?:\.\d+)?"


def is_decimal_text(c: Column | str) -> Column:
    return strip(c).rlike(DECIMAL_PATTERN)


# Letters a Java number may hold but a data value may not (suffixes, hex, NaN, Infinity).
_NOT_NUMERIC = "dDfFnNxXpP"


def safe_double(c: Column | str, comma: bool = True) -> Column:
    """Text to double; null where the text is no number. A decimal comma is read as a point."""
    signs, meant = ("," + _NOT_NUMERIC, "." + "#" * len(_NOT_NUMERIC)) if comma else (_NOT_NUMERIC, "#" * len(_NOT_NUMERIC))
    return F.translate(strip(c), signs, meant).try_cast("double")


def number_from_text(c: Column | str) -> Column:
    """First signed number inside a text."""
    return F.regexp_extract(_col(c), SIGNED_NUMBER_PATTERN, 0).try_cast("double")


def count_if(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def percentage(part: Column, total: Column) -> Column:
    return part.cast("double") * 100.0 / F.nullif(total.cast("double"), F.lit(0.0))


def format_thousands(c: Column | str) -> Column:
    """12680 -> '12.680'."""
    return F.translate(F.format_number(_col(c), 0), ",", ".")
