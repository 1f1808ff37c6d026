"""Growth shapes as fractions, and totals spread along such shapes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.functions import ratio, round_half_even
from rapport.operators import bootstrap_assign, share_of_max, split_join

TEMPLATE_MEASURES = ("users", "matched_voters", "reach_adds", "voters_per_cm_week", "votes")


def fit_template(
    series: DataFrame, group: str, until: dt.date, measures: tuple[str, ...] = TEMPLATE_MEASURES
) -> DataFrame:
    """Each measure of a series as a share of its group's largest value."""
    kept = series.where(F.col("day") <= F.lit(until)).select(group, "day", *measures)
    return share_of_max(kept, group, list(measures)).withColumnRenamed(group, "group")


def scale_template(totals: DataFrame, template: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """Spread each group's totals along the days of one randomly assigned template group.

    The draw depends on the group's keys and the seed only. Counts are rounded
    half to even.
    """
    id = "_id"
    named = totals.withColumn(id, F.concat_ws("|", *keys))
    groups = template.select("group").distinct()
    drawn = bootstrap_assign(named, id, groups, "group", seed).drop(id)
    # A template's days travel as one row, so a join row is a group and not a group's day; few
    # templates are few join keys, each of which may be hot.
    measures = ("users", "matched_voters", "reach_adds", "votes")
    columns = ("day", *[f"{m}_ptg" for m in (*measures, "voters_per_cm_week")])
    packed = template.groupBy("group").agg(F.collect_list(F.struct(*columns)).alias("_days"))
    spread = split_join(drawn, packed, "group").withColumn("_day", F.explode("_days"))
    scaled = {m: round_half_even(F.col(f"_day.{m}_ptg") * F.col(m)) for m in measures}
    return spread.select(
        *keys,
        "_day.day",
        *[value.alias(m) for m, value in scaled.items()],
        (F.col("_day.voters_per_cm_week_ptg") * F.col("voters_per_cm_week")).alias("voters_per_cm_week"),
    ).withColumn("pct_votes", ratio(F.col("votes"), F.col("matched_voters")))


def topline_template(topline: DataFrame, users: DataFrame) -> DataFrame:
    """Join date, matched and added counts per user, zero where unknown."""
    return (
        topline.select("user_id", "matched_voters", "reach_adds")
        .join(users.select("user_id", "date_joined"), "user_id", "left")
        .select("date_joined", "matched_voters", "reach_adds")
        .fillna(0, ["matched_voters", "reach_adds"])
    )
