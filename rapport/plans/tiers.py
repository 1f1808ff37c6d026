"""Contact priority of a person: tier 1 (most) to 4 (not a target)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.labels import SupportCodes, TierRules
from rapport.operators import latest_value
from rapport.plans.status import voted_sets


def support_merge(
    external: DataFrame, answers: DataFrame, crosswalk: DataFrame, voter_file: DataFrame, codes: SupportCodes
) -> DataFrame:
    """Support codes from both systems: 1 for, 3 undecided, 5 against, -1 otherwise."""
    answer = F.col("master_survey_response_id")
    theirs = external.where(F.col("master_survey_question_id").isin(*codes.questions)).select(
        "person_id",
        F.when(answer.isin(*codes.support), 1)
        .when(answer.isin(*codes.undecided), 3)
        .when(answer.isin(*codes.against), 5)
        .otherwise(-1)
        .cast("bigint")
        .alias("value"),
        "datetime_canvassed",
    )
    score = F.col("response_numeric")
    ours = (
        answers.where(score.isNotNull())
        .join(crosswalk, "reach_id")
        .join(voter_file.select("sos_id", "person_id"), "sos_id")
        .select(
            "person_id",
            F.when(score.isin(1, 2), 1).when(score.isin(4, 5), 5).otherwise(score).cast("bigint").alias("value"),
            F.col("canvass_timestamp").alias("datetime_canvassed"),
        )
    )
    return theirs.unionByName(ours)


def voter_tiers(
    voter_file: DataFrame,
    absentee: DataFrame,
    scores: DataFrame,
    external: DataFrame,
    answers: DataFrame,
    crosswalk: DataFrame,
    rules: TierRules,
) -> DataFrame:
    """Tier by latest support code, else by scores; anyone who voted gets 4.

    ``scores`` holds one row per person.
    """
    merged = support_merge(external, answers, crosswalk, voter_file, rules.codes)
    support = latest_value(merged, ["person_id"], "datetime_canvassed", "value", "max").drop("datetime_canvassed")
    scored = scores.select("person_id", "modeled_support_score", "gotv_score")
    value, gotv, model = F.col("value"), F.col("gotv_score"), F.col("modeled_support_score")
    unscored = gotv.isNull()
    tier = (
        F.when(value.isin(5, -1), 4)
        .when(value == 3, 3)
        .when(value == 1, 1)
        .when(((model >= rules.high_support) & F.col("pending")) | (gotv >= rules.high_gotv), 1)
        .when((gotv >= rules.mid_gotv) | (unscored & (model >= rules.mid_support)), 2)
        .when((gotv > 0) | (unscored & (model >= rules.low_support)), 3)
        .otherwise(4)
    )
    return (
        voter_file.where("reg_on_current_file")
        .select("person_id")
        .join(support, "person_id", "left")
        .join(scored, "person_id", "left")
        .join(voted_sets(absentee, voter_file), "person_id", "left")
        .select("person_id", tier.alias("tier_raw"), F.coalesce("voted", F.lit(False)).alias("voted"))
        .select("person_id", F.when(F.col("voted"), 4).otherwise(F.col("tier_raw")).alias("tier"), "tier_raw", "voted")
    )
