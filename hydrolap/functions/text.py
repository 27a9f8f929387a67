"""Text and missing-value columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from ..domain import MISSING_MARKERS

_BLANKS = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim blanks, tabs and line breaks at both ends."""
    return F.btrim(_col(c), F.lit(_BLANKS))


def is_missing(c: Column | str, markers: tuple[str, ...] = MISSING_MARKERS) -> Column:
    """True for null and for marker texts, trimmed and in any case."""
    return F.coalesce(F.lower(strip(c)).isin(*[m.lower() for m in markers]), F.lit(True))


def null_if_missing(c: Column | str, markers: tuple[str, ...] = MISSING_MARKERS) -> Column:
    return F.when(~is_missing(c, markers), strip(c))


def missing_to_category(c: Column | str, category: str, markers: tuple[str, ...] = MISSING_MARKERS) -> Column:
    return F.coalesce(null_if_missing(c, markers), F.lit(category))


def normalise_place(c: Column | str, at_to: str | None = None) -> Column:
    """Trimmed upper case; with ``at_to`` the sign ``@`` becomes that letter."""
    name = F.upper(strip(c))
    return F.translate(name, "@", at_to) if at_to else name


def display_name(c: Column | str, overrides: dict[str, str] | None = None) -> Column:
    """Title case, unless the name has a spelling of its own in ``overrides``."""
    titled = F.initcap(_col(c))
    if not overrides:
        return titled
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(overrides.items())])
    return F.coalesce(F.try_element_at(known, _col(c)), titled)


def mask_digits(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[0-9]", "9")
