"""Aggregations. Distinct counts go through a deduplicating aggregate first, so
that a hot group is reduced on the map side and no Expand is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import ratio


def distinct_counts(df: DataFrame, keys: list[str], id: str, counts: dict[str, Column | None]) -> DataFrame:
    """Several conditional ``COUNT(DISTINCT id)`` per key.

    ``counts`` maps an output name to its condition, or to None for all rows.
    A row meets a condition only where it is true.
    """
    met = {name: F.lit(True) if cond is None else F.coalesce(cond, F.lit(False)) for name, cond in counts.items()}
    per_id = df.groupBy(*keys, id).agg(*[F.max(cond).alias(name) for name, cond in met.items()])
    known = F.col(id).isNotNull()
    return per_id.groupBy(*keys).agg(*[F.count_if(F.col(name) & known).alias(name) for name in counts])


def sum_once(df: DataFrame, keys: list[str], unit: list[str], value: str, name: str) -> DataFrame:
    """Sum a value repeated on many rows, counting each distinct (unit, value) once."""
    return df.select(*keys, *unit, value).distinct().groupBy(*keys).agg(F.sum(value).alias(name))


def pivot_answers(df: DataFrame, id: str, name: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Key/value answers to one wide row per id.

    ``columns`` maps an output column to (question name, value column); several
    answers to one question give the largest.
    """
    return df.groupBy(id).agg(
        *[F.max(F.when(F.col(name) == q, F.col(v))).alias(out) for out, (q, v) in columns.items()]
    )


def share_of_max(df: DataFrame, group: str, measures: list[str], suffix: str = "_ptg") -> DataFrame:
    """Each measure as a share of its largest value in the group.

    The maxima are aggregated and joined back rather than taken in a window, so
    a group's rows are never sorted into one task.
    """
    peaks = df.groupBy(F.col(group).alias("_group")).agg(*[F.max(m).alias(f"_max_{m}") for m in measures])
    rest = [c for c in df.columns if c not in measures]
    return df.join(peaks, F.col(group).eqNullSafe(F.col("_group")), "left").select(
        *rest, *[ratio(F.col(m), F.col(f"_max_{m}")).alias(m + suffix) for m in measures]
    )


def frequency(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """How often each value of an expression occurs."""
    return df.groupBy(expr.alias(name)).agg(F.count(F.lit(1)).alias("n"))


