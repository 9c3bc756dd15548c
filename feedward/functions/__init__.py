"""Column-level building blocks. Everything here stays inside code generation."""

from feedward.functions.numbers import (
    is_positive,
    number_prefix,
    percent,
    round_half_up,
    shortfall_ratio,
)
from feedward.functions.predicates import any_present, breach_label, count_where, older_than
from feedward.functions.times import day_of, second_of, stamp_literal

__all__ = [
    "any_present",
    "breach_label",
    "count_where",
    "day_of",
    "is_positive",
    "number_prefix",
    "older_than",
    "percent",
    "round_half_up",
    "second_of",
    "shortfall_ratio",
    "stamp_literal",
]
