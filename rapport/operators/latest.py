"""Latest and first rows per key.

A key may hold a large share of all rows, so none of these gathers a key's rows
in one task: extremes come from aggregates that combine on the map side, and
the rows are found again by an equi-join that AQE can split. ``latest_one``
uses ``row_number() = 1``, for which Spark keeps one row per key and map task
before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rows_at(df: DataFrame, keys: list[str], ts: str, extreme: Column) -> DataFrame:
    picked = df.where(F.col(ts).isNotNull()).groupBy(*keys).agg(extreme.alias("_at"))
    picked = picked.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_at")
    # null keys form a group of their own, as in a window partition
    same_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    cond = reduce(lambda a, b: a & b, same_key, F.col(ts) == F.col("_at"))
    return df.join(picked, cond, "left_semi")


def latest_ties(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """All rows at the latest ``ts`` of their key."""
    return _rows_at(df, keys, ts, F.max(ts))


def first_touch(edges: DataFrame, id: str, group_keys: list[str], ts: str) -> DataFrame:
    """All rows at the earliest ``ts`` of an id inside its group."""
    return _rows_at(edges, [id, *group_keys], ts, F.min(ts))


def break_ties(df: DataFrame, keys: list[str], value: str, how: str = "min") -> DataFrame:
    """One row per key, with the smallest or largest of the tied values."""
    pick = {"min": F.min, "max": F.max}[how]
    return df.groupBy(*keys).agg(pick(value).alias(value))


def latest_value(df: DataFrame, keys: list[str], ts: str, value: str, how: str = "min") -> DataFrame:
    """``latest_ties`` then ``break_ties`` in two aggregates and no join.

    The first aggregate breaks ties per (key, ts), the second keeps the latest.
    """
    tied = df.where(F.col(ts).isNotNull())
    tied = break_ties(tied, [*keys, ts], value, how)
    return tied.groupBy(*keys).agg(
        F.max(ts).alias(ts),
        F.max_by(value, ts).alias(value),
    )


def latest_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Exactly one row per key; end ``order`` with a unique column to be repeatable."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_answer(
    responses: DataFrame, question: str, id: str, ts: str, required: str, day: str
) -> DataFrame:
    """Day of the first answer to each question, whoever recorded it.

    A row without ``required`` still claims the first place and so hides later
    answers: the first moment is taken over all rows, then compared with the
    first moment over complete rows.
    """
    complete = F.col(required).isNotNull()
    return (
        responses.groupBy(question, id)
        .agg(
            F.min(ts).alias("_first"),
            F.min(F.when(complete, F.col(ts))).alias("_first_complete"),
            F.min(F.when(complete & F.col(ts).isNotNull(), F.col(day))).alias("day"),
        )
        .where(F.col("_first") == F.col("_first_complete"))
        .select(question, id, "day")
    )
