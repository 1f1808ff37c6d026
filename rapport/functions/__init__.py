"""Column expressions. Everything here is built from native Spark functions."""

from rapport.functions.dates import days_between, readable_days, today_in
from rapport.functions.keys import add_prefix, clean_phone, full_name, strip_prefix, title_case
from rapport.functions.numbers import (
    greatest_strict,
    ratio,
    round_half_even,
    stable_hash,
    to_int,
    unit_hash,
)
from rapport.functions.text import choices, choices_text

__all__ = [
    "add_prefix",
    "choices",
    "choices_text",
    "clean_phone",
    "days_between",
    "full_name",
    "greatest_strict",
    "ratio",
    "readable_days",
    "round_half_even",
    "stable_hash",
    "strip_prefix",
    "title_case",
    "to_int",
    "today_in",
    "unit_hash",
]
