"""Membership joins: flags, exclusions, and widening a set through a shared key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_join(
    df: DataFrame, other: DataFrame, on: str | list[str], how: str = "inner", hot: bool = True
) -> DataFrame:
    """Equi-join whose hot keys AQE can split; ``how`` is inner, left, left_semi or left_anti.

    AQE splits a skewed partition only if both inputs come straight from a shuffle
    made for the join and nothing after it relies on that shuffle. An input that
    was aggregated by the same key skips the shuffle, and a later aggregate over
    more columns reuses it. Comparing null-safe makes Spark shuffle by derived
    columns, which rules out both. Null keys are taken from ``other`` first, so
    they still match nothing. ``hot=False`` states that no key is hot: a plain join then
    uses the bucketing or partitioning that the inputs have.
    """
    if not hot:
        return df.join(other, on, how)
    keys = [on] if isinstance(on, str) else list(on)
    names = {k: f"_other_{k}" for k in keys}
    right = other.dropna("any", subset=keys).withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()])
    return df.join(right, same, how).drop(*names.values())


def mark_join(df: DataFrame, keys_df: DataFrame, on: str, name: str, three_valued: bool = False) -> DataFrame:
    """Add a boolean column telling whether ``on`` occurs in ``keys_df``.

    ``three_valued`` follows SQL ``IN``: where it is not found, a null key against a
    list that is not empty, or a list that holds a null, gives null instead of false.
    """
    known = keys_df.select(on).distinct().withColumn("_known", F.lit(True))
    marked = split_join(df, known, on, "left")
    absent = F.lit(False)
    if three_valued:
        state = _list_state(keys_df, on)
        unsure = (state == 2) | ((state == 1) & F.col(on).isNull())
        absent = F.when(unsure, F.lit(None).cast("boolean")).otherwise(False)
    return marked.withColumn(name, F.coalesce("_known", absent)).drop("_known")


def _list_state(keys_df: DataFrame, key: str) -> Column:
    """Scalar subquery over a list: 0 if it is empty, 1 if it holds no null, 2 if it does."""
    nulls = F.count_if(F.col(key).isNull())
    return keys_df.agg(F.when(F.count(F.lit(1)) == 0, 0).when(nulls == 0, 1).otherwise(2)).scalar()


def anti(df: DataFrame, keys_df: DataFrame, on: str | list[str], null_aware: bool = False) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys_df``.

    ``null_aware`` follows SQL ``NOT IN`` on one key: an empty list keeps every
    row, a null in the list keeps none, and a null key is dropped. The list is
    summarised by one scalar subquery, so the join stays a plain shuffled anti
    join at any size where Spark's own ``NOT IN`` broadcasts the whole list.
    """
    keys = [on] if isinstance(on, str) else list(on)
    right = keys_df.select(*keys)
    kept = split_join(df, right, keys, "left_anti")
    if not null_aware:
        return kept
    (key,) = keys
    state = _list_state(right, key)
    return kept.where((state == 0) | ((state == 1) & F.col(key).isNotNull()))


def expand_by_shared_key(seed: DataFrame, base: DataFrame, id: str, shared: str) -> DataFrame:
    """Distinct ids of ``base`` that share a key (a household) with an id of ``seed``.

    Goes through the distinct shared keys, so a crowded key never yields pairs.
    """
    touched = split_join(base, seed.select(id), id, "left_semi").select(shared).distinct()
    return split_join(base, touched, shared, "left_semi").select(id).distinct()
