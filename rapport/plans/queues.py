"""Work lists: members' people, and users outside the member program."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import full_name
from rapport.labels import ADDED_TAG, HAS_VOTED, MATCHED_TAG, NEEDS_TO_VOTE, TIER_TEXT, VOTED_RAW
from rapport.operators import anti, mark_join, split_join


def tier_text(tier: Column) -> Column:
    text = F.when(tier.isNull(), TIER_TEXT[4])
    for n, label in TIER_TEXT.items():
        text = text.when(tier == n, label)
    return text


def work_queue(
    edges: DataFrame, members: DataFrame, wide: DataFrame, status: DataFrame, person_tier: DataFrame
) -> DataFrame:
    """Each member's active people with answers, status, tier and sort keys.

    ``person_tier`` is the tier per person id; the text shows it before the tier
    of a person without a file record is set to 4. What is known of a person is
    put together first, so relationships meet it in one join that AQE can split
    where one person is known to very many members.
    """
    known = wide.join(status, "reach_id", "full").join(person_tier, "reach_id", "full")
    pairs = (
        edges.where("relationship_status = 'Active'")
        .select(
            "user_id",
            "reach_id",
            full_name(F.col("person_first_name"), F.col("person_last_name")).alias("voter"),
        )
        .distinct()
    )
    code, status_text = F.col("support_id_numeric"), F.col("voting_status")
    sort_1 = F.when(status_text == HAS_VOTED, 10).when(status_text.isNull(), 5).otherwise(0)
    sort_2 = F.when(code.isin(1, 2), 10).when(code == 3, 5).when(code.isNull(), 3).otherwise(1)
    return (
        split_join(split_join(pairs, members, "user_id"), known, "reach_id", "left")
        .withColumns(
            {
                "tier_str": tier_text(F.col("tier")),
                "tier": F.when(F.col("sos_id").isNull(), 4).otherwise(F.col("tier")),
                "sos_id": F.coalesce(F.col("sos_id").cast("string"), F.lit(ADDED_TAG)),
                "sort_1": sort_1,
                "sort_2": sort_2,
            }
        )
    )


def volunteer_users(users: DataFrame, members: DataFrame, edges: DataFrame, status: DataFrame) -> DataFrame:
    """Users who are not members, with their network, matched and voted counts."""
    voted = status.where(F.col("voting_status_raw").isin(*VOTED_RAW))
    pairs = edges.where("reach_id IS NOT NULL").groupBy("user_id", "reach_id").agg(
        F.max(F.col("state_file_id").isNotNull()).alias("is_matched"),
        F.max(F.coalesce(F.col("auto_applied_tag") == MATCHED_TAG, F.lit(False))).alias("is_voter"),
    )
    theirs = mark_join(anti(pairs, members, "user_id"), voted, "reach_id", "has_voted")
    counts = theirs.groupBy("user_id").agg(
        F.count("reach_id").alias("voters"),
        F.count_if("is_matched").alias("matched_voters"),
        F.count_if(F.col("is_voter") & F.col("has_voted")).alias("voters_voted"),
    )
    return (
        anti(users, members, "user_id")
        .join(counts, "user_id", "left")
        .select(
            "user_id",
            full_name(F.col("first_name"), F.col("last_name")).alias("name"),
            "phone_number",
            "date_joined",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("voters", "matched_voters", "voters_voted")],
        )
    )


def volunteer_people(edges: DataFrame, members: DataFrame, wide: DataFrame, status: DataFrame) -> DataFrame:
    """People of non-members who have not voted."""
    raw = F.col("voting_status_raw")
    known = wide.select("reach_id", "support_id", "vote_plan", "detailed_plan", "vol_ask").join(
        status.select("reach_id", "voting_status_raw").distinct(), "reach_id", "full"
    )
    listed = edges.select(
        "reach_id", "user_id", "user_name", "auto_applied_tag", "person_first_name", "person_last_name"
    ).distinct()
    # both sides are distinct, and so is the result
    return (
        split_join(anti(listed, members, "user_id"), known, "reach_id", "left")
        .where(raw.isNull() | ~raw.isin(*VOTED_RAW))
        .select(
            "reach_id",
            "user_id",
            "user_name",
            "auto_applied_tag",
            "person_first_name",
            "person_last_name",
            "support_id",
            "vote_plan",
            "detailed_plan",
            "vol_ask",
            F.when(raw == NEEDS_TO_VOTE, "").otherwise(raw).alias("voting_status"),
        )
    )
