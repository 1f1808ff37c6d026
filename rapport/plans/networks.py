"""Person-level summaries and the per-user network counts built on them.

A person's status, answers and tiers are folded to one row per person first, so
every report over relationships needs one join per summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.labels import HAS_VOTED
from rapport.operators import split_join

TIERS = (1, 2, 3, 4)


def active_pairs(edges: DataFrame) -> DataFrame:
    """Distinct active (user_id, reach_id)."""
    return edges.where("relationship_status = 'Active'").select("user_id", "reach_id").distinct()


def nonvoting_flag(status: DataFrame) -> DataFrame:
    """Per person: whether any status row says the vote is still open."""
    return status.groupBy("reach_id").agg(F.max(F.col("voting_status") != HAS_VOTED).alias("nonvoting"))


def tier_counts(tiers: DataFrame, voter_file: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Per person: how many of the matching file records are in each tier."""
    records = voter_file.where("reg_on_current_file").select("sos_id", "person_id")
    return (
        crosswalk.select("reach_id", "sos_id")
        .join(records, "sos_id")
        .join(tiers.select("person_id", "tier"), "person_id")
        .groupBy("reach_id")
        .agg(
            *[F.count_if(F.col("tier") == t).alias(f"tier{t}") for t in TIERS],
            F.count(F.lit(1)).alias("records"),
        )
    )


def tier_by_person(tiers: DataFrame, voter_file: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Per person id: the largest tier of the matching file records."""
    return (
        crosswalk.select("reach_id", "sos_id")
        .join(voter_file.select("sos_id", "person_id"), "sos_id")
        .join(tiers.select("person_id", "tier"), "person_id")
        .groupBy("reach_id")
        .agg(F.max("tier").alias("tier"))
    )


def network_scores(
    edges: DataFrame, crosswalk: DataFrame, voter_file: DataFrame, absentee: DataFrame, tiers: DataFrame
) -> DataFrame:
    """Tier counts of each user's active people who have not voted.

    A person counts as not voted when any of their absentee rows has no vote date.
    """
    open_people = (
        crosswalk.select("reach_id", "sos_id")
        .join(voter_file.select("sos_id", "myv_van_id"), "sos_id")
        .join(absentee.select("myv_van_id", "date_ballot_received", "date_early_voted"), "myv_van_id", "left")
        .where("date_ballot_received IS NULL AND date_early_voted IS NULL")
        .select("reach_id")
        .distinct()
    )
    people = tier_counts(tiers, voter_file, crosswalk).join(open_people, "reach_id", "left_semi")
    return (
        split_join(active_pairs(edges), people, "reach_id")
        .groupBy("user_id")
        .agg(
            *[F.sum(f"tier{t}").alias(f"tier{t}") for t in TIERS],
            F.sum("records").alias("scored_network_size"),
        )
    )
