"""Column functions and the expectation model (compiled to aggregates)."""

from strata.functions.columns import discounted, month_start, round_half_away
from strata.functions.expectations import (
    Expectation,
    Suite,
    between,
    match_regex,
    not_null,
    row_count_between,
)

__all__ = [
    "Expectation",
    "Suite",
    "between",
    "discounted",
    "match_regex",
    "month_start",
    "not_null",
    "round_half_away",
    "row_count_between",
]
