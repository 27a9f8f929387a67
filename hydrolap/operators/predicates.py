"""Row predicates over raw text records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..domain import RECENCY_MONTHS, RISK_TYPO
from ..functions import is_missing, parse_date, risk_class, safe_double, strip
from ..functions.dates import ISO_DATE
from ..functions.text import _col


def not_iso(date_text: Column | str) -> Column:
    return ~F.coalesce(_col(date_text).rlike(ISO_DATE), F.lit(False))


def untidy(text: Column | str) -> Column:
    """Untrimmed, all upper, all lower, or with ``@``. A text without letters is neither case."""
    t = _col(text)
    upper = (t == F.upper(t)) & (t != F.lower(t))
    lower = (t == F.lower(t)) & (t != F.upper(t))
    return F.coalesce((t != strip(t)) | upper | lower | F.contains(t, F.lit("@")), F.lit(False))


def class_mismatch(value_text: Column | str, stored: Column | str, labels=None) -> Column:
    """Recomputed class differs from the stored one, both present."""
    value = safe_double(value_text)
    expected = risk_class(value, labels) if labels else risk_class(value)
    present = value.isNotNull() & ~is_missing(stored)
    return F.coalesce(present & (expected != strip(stored)), F.lit(False))


def class_orphan(value_text: Column | str, stored: Column | str) -> Column:
    """Class present without the value it comes from."""
    return is_missing(value_text) & ~is_missing(stored)


def date_parts_differ(date_text: Column | str, year_text: Column | str, month_text: Column | str) -> Column:
    """Year or month column disagrees with a readable ISO date; other dates are not judged."""
    d = F.when(~not_iso(date_text), parse_date(date_text))
    same = (F.year(d) == _col(year_text).try_cast("int")) & (F.month(d) == _col(month_text).try_cast("int"))
    return d.isNotNull() & ~F.coalesce(same, F.lit(False))


def misspelled_class(stored: Column | str) -> Column:
    return F.coalesce(F.startswith(_col(stored), F.lit(RISK_TYPO)), F.lit(False))


def outside(value: Column, low: float, high: float) -> Column:
    """Out of the domain; null is not judged."""
    return F.coalesce(~value.between(low, high), F.lit(False))


def recent(d: Column, as_of: Column, months: int = RECENCY_MONTHS) -> Column:
    return F.coalesce(d >= F.add_months(as_of, -months), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])
