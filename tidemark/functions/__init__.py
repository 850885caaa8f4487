from tidemark.functions.keys import composite_key
from tidemark.functions.money import exact_avg, exact_sum
from tidemark.functions.text import strip_whitespace
from tidemark.functions.time import as_naive_timestamp, month_of, seconds_between, week_of

__all__ = [
    "as_naive_timestamp",
    "composite_key",
    "exact_avg",
    "exact_sum",
    "month_of",
    "seconds_between",
    "strip_whitespace",
    "week_of",
]
