from tidemark.functions.columns import (
    at_least,
    between_bounds,
    days_between,
    finite_or_zero,
    from_cents,
    iso_date,
    iso_seconds,
    month_of,
    months_between_starts,
    ratio_or,
    smoothed_ratio,
    to_cents,
)
from tidemark.functions.display import count_text, money_text, percent_text, percentage_text

__all__ = [
    "at_least",
    "between_bounds",
    "count_text",
    "days_between",
    "finite_or_zero",
    "from_cents",
    "iso_date",
    "iso_seconds",
    "money_text",
    "month_of",
    "months_between_starts",
    "percent_text",
    "percentage_text",
    "ratio_or",
    "smoothed_ratio",
    "to_cents",
]
