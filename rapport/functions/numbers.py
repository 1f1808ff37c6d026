"""Arithmetic with the null and zero rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; null instead of an error on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Banker's rounding, unlike ``round`` which sends halves away from zero."""
    return F.bround(value, digits)


def to_int(text: Column) -> Column:
    """Integer from text; anything unparsable, '' included, is null."""
    return text.try_cast("int")


def greatest_strict(a: Column, b: Column) -> Column:
    """Greater of two values, null as soon as one of them is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def stable_hash(key: Column, seed: int) -> Column:
    """Non-negative 60-bit hash of a key, the same on any engine and partitioning."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 15)
    return F.conv(hexed, 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int) -> Column:
    """Repeatable uniform number in [0, 1) per key."""
    return stable_hash(key, seed).cast("double") / F.lit(float(2**60))
