"""Outreach lists: who to enrol, tag, or put in which group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import add_prefix
from rapport.labels import HAS_VOTED, SupportCodes
from rapport.operators import anti, mark_join


def id_crosswalk(notes: DataFrame, records: DataFrame, category: str) -> DataFrame:
    """Ids of one system noted on the records of another."""
    noted = notes.where(F.col("note_category_name") == category)
    # distinct on either side gives distinct triples
    return (
        noted.select("myc_van_id", F.col("note_text").alias("reach_user_id"))
        .distinct()
        .join(records.select("myc_van_id", "myv_van_id").distinct(), "myc_van_id")
        .select("reach_user_id", "myc_van_id", "myv_van_id")
    )


def not_enrolled(users: DataFrame, notes: DataFrame, category: str, null_aware: bool = False) -> DataFrame:
    """Users whose id is not noted in the other system yet."""
    noted = notes.where(F.col("note_category_name") == category).select(F.col("note_text").alias("user_id"))
    return anti(users, noted, "user_id", null_aware).select(
        "user_id", "first_name", "last_name", "email_address", "zip_code", "state", "phone_number"
    )


def support_scores(external: DataFrame, scores: DataFrame, codes: SupportCodes) -> DataFrame:
    """Support from 0 to 100: the current coded answer, else the model score."""
    answer = F.col("master_survey_response_id")
    coded = external.where(
        F.col("master_survey_question_id").isin(*codes.questions) & (F.col("msq_currency") == 1)
    ).select("person_id", "master_survey_response_id").distinct()
    score = (
        F.when(answer.isin(*codes.support), F.lit(100.0))
        .when(answer.isin(*codes.undecided), F.lit(50.0))
        .otherwise(F.col("model_support_score"))
    )
    return (
        coded.join(scores.select("person_id", "model_support_score"), "person_id", "full")
        .select("person_id", score.alias("support_score"))
        .distinct()
    )


def uncontactable(
    status: DataFrame,
    voter_file: DataFrame,
    crosswalk: DataFrame,
    phones: DataFrame,
    support: DataFrame,
    tags: DataFrame,
    tag_id: str,
    prefix: str,
    null_aware: bool = False,
) -> DataFrame:
    """People reachable only through their contact: not voted, no phone on file,
    supportive or unknown, and not tagged as such yet."""
    phoned = (
        crosswalk.select("reach_id", "sos_id")
        .join(voter_file.select("sos_id", "myv_van_id"), "sos_id")
        .join(phones.where("phone_number IS NOT NULL"), "myv_van_id", "left_semi")
        .select("reach_id")
    )
    tagged = tags.where((F.col("tag_action") == "Added") & (F.col("tag_id") == tag_id)).select("state_file_id")
    open_people = status.where(F.col("voting_status") != HAS_VOTED).select("reach_id", "sos_id")
    current = voter_file.where("reg_on_current_file").select("sos_id", "person_id")
    candidates = (
        anti(open_people, phoned, "reach_id", null_aware)
        .join(current, "sos_id")
        .join(support, "person_id", "left")
        .where("support_score IS NULL OR support_score >= 50")
        .select(add_prefix(F.col("sos_id"), prefix).alias("state_file_id"))
        .distinct()
    )
    return anti(candidates, tagged, "state_file_id", null_aware)


def segment(is_member: Column, state: Column, home_state: str, groups: dict[str, str]) -> Column:
    """Group of a user; a user whose state is unknown falls under everyone else."""
    return (
        F.when(is_member, groups["member"])
        .when(state != home_state, groups["out_of_state"])
        .otherwise(groups["everyone_else"])
    )


def user_segments(users: DataFrame, members: DataFrame, home_state: str, groups: dict[str, str]) -> DataFrame:
    """Distinct (user_id, group_id)."""
    flagged = mark_join(users.select("user_id", "state"), members, "user_id", "is_member")
    group = segment(F.col("is_member"), F.col("state"), home_state, groups)
    return flagged.select("user_id", group.alias("group_id")).distinct()
