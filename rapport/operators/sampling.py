"""Repeatable random assignment: draws depend on ids and a seed, not on partitions."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rapport.functions import stable_hash, unit_hash
from rapport.operators.joins import split_join

# Rows are numbered in GROUPS * GROUPS ranges of their hash, whatever their number.
GROUPS = 256


def dense_index(df: DataFrame, order: str, seed: int = 0, groups: int = GROUPS) -> DataFrame:
    """Number rows 0..n-1 in column ``idx``, in the order of (hash of ``order``, ``order``).

    The hash is cut into ``groups`` ranges of ``groups`` ranges each. Rows are numbered
    inside a range and shifted by the rows in the ranges before: those of the same
    group by a window over ``groups`` rows, those of earlier groups by adding each
    group's size to all later ones. So no task sees more than a range, and the
    result does not depend on ``groups``: a row more shifts others by one at most.
    ``order`` must be unique.
    """
    width = 2**60 // (groups * groups)
    hashed = stable_hash(F.col(order), seed)
    cell = F.least(F.floor(hashed / F.lit(width)), F.lit(groups * groups - 1))
    rows = df.withColumn("_hash", hashed).withColumn("_cell", cell)
    sizes = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_group", F.floor(F.col("_cell") / F.lit(groups)))
    later = sizes.groupBy("_group").agg(F.sum("_size").alias("_rows"))
    later = later.where(F.col("_group") < groups - 1).select(
        F.explode(F.sequence(F.col("_group") + 1, F.lit(groups - 1).cast("bigint"))).alias("_group"), "_rows"
    )
    before = later.groupBy("_group").agg(F.sum("_rows").alias("_before"))
    w = Window.partitionBy("_group").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(w), F.lit(0)))
    starts = starts.join(before, "_group", "left").select(
        "_cell", (F.col("_start") + F.coalesce("_before", F.lit(0))).alias("_start")
    )
    rn = F.row_number().over(Window.partitionBy("_cell").orderBy("_hash", order))
    return (
        rows.withColumn("_rn", rn)
        .join(starts, "_cell")
        .withColumn("idx", F.col("_start") + F.col("_rn") - 1)
        .drop("_hash", "_cell", "_start", "_rn")
    )


def bootstrap_assign(df: DataFrame, id: str, dist: DataFrame, order: str, seed: int = 0) -> DataFrame:
    """Give each row of ``df`` one row of ``dist``, drawn with replacement."""
    size = dist.agg(F.count(F.lit(1))).scalar()
    draws = df.withColumn("idx", F.try_mod(stable_hash(F.col(id), seed), size))
    # A small ``dist`` makes few and so hot numbers.
    return split_join(draws, dense_index(dist, order, seed), "idx").drop("idx")


def weighted_assign(df: DataFrame, id: str, weights: dict[str, float], name: str, seed: int = 0) -> DataFrame:
    """Draw one of a few labels per row with the given weights."""
    total = sum(weights.values())
    labels = list(weights)
    bounds = [c / total for c in accumulate(weights.values())]
    u = unit_hash(F.col(id), seed)
    pick: Column | None = None
    for label, bound in list(zip(labels, bounds))[:-1]:
        pick = F.when(u < bound, label) if pick is None else pick.when(u < bound, label)
    last = F.lit(labels[-1])
    return df.withColumn(name, last if pick is None else pick.otherwise(last))
