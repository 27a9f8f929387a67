"""Column functions: text, missing values, dates, numbers and classes."""

from .dates import calendar_columns, month_agrees, parse_date, earlier_block, previous_period
from .numbers import count_if, format_thousands, is_decimal_text, number_from_text, percentage, safe_double
from .risk import quadrant, risk_class, risk_group, risk_group_of_class
from .text import display_name, is_missing, mask_digits, missing_to_category, normalise_place, null_if_missing, strip

__all__ = [
    "calendar_columns", "count_if", "display_name", "format_thousands", "is_decimal_text", "is_missing",
    "mask_digits", "missing_to_category", "month_agrees", "normalise_place", "null_if_missing",
    "number_from_text", "parse_date", "percentage", "earlier_block", "previous_period", "quadrant",
    "risk_class", "risk_group", "risk_group_of_class", "safe_double", "strip",
]
