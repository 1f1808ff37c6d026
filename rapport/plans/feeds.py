"""E-mail feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.functions import strip_prefix
from rapport.labels import NEEDS_TO_VOTE
from rapport.operators import distinct_counts, expand_by_shared_key, latest_ties, mark_join
from rapport.plans.status import raw_status


def feed_relationships(edges: DataFrame, prefix: str) -> DataFrame:
    """Active relationships to people on the file, with their bare file id."""
    return edges.where("relationship_status = 'Active' AND state_file_id IS NOT NULL").select(
        "reach_id",
        strip_prefix(F.col("state_file_id"), prefix).alias("sos_id"),
        "user_id",
        "user_name",
        "relationship_type",
    )


def feed_users(users: DataFrame, edges: DataFrame, id_crosswalk: DataFrame, members: DataFrame) -> DataFrame:
    """Users with their external id, leader e-mail and number of unmatched people."""
    adds = distinct_counts(
        edges.where("state_file_id IS NULL"), ["user_id"], "reach_id", {"num_reach_adds": None}
    )
    ids = id_crosswalk.select(F.col("reach_user_id").alias("user_id"), F.col("myv_van_id").alias("canvasser_vanid"))
    return (
        users.join(adds, "user_id", "left")
        .join(ids, "user_id", "left")
        .join(members.select("user_id", "rmm_email"), "user_id", "left")
        .select(
            "user_id",
            "first_name",
            "last_name",
            "email_address",
            "phone_number",
            "canvasser_vanid",
            "rmm_email",
            "role",
            "date_joined",
            "added_method",
            "invite_code",
            "invite_code_name",
            "added_by_user_id",
            F.coalesce("num_reach_adds", F.lit(0)).alias("num_reach_adds"),
        )
    )


def named_answers(
    responses: DataFrame, names: DataFrame, question: str, answer: str, current: str, wanted: str, out: str
) -> DataFrame:
    """Current answer to one external question by name, joined on (question, answer)."""
    return (
        responses.where((F.col(question) == wanted) & (F.col(current) == 1))
        .join(names, [question, answer])
        .select("myv_van_id", F.col(f"{answer.removesuffix('_id')}_name").alias(out))
    )


def latest_by_file_id(response_list: DataFrame, question: str, out: str, prefix: str) -> DataFrame:
    """Latest answers to one question by bare file id, ties kept."""
    asked = response_list.where(F.col("question_name") == question)
    return latest_ties(asked, ["question_id", "reach_id"], "canvass_timestamp").select(
        strip_prefix(F.col("state_file_id"), prefix).alias("sos_id"), F.col("response_value").alias(out)
    )


def expanded_network(edges: DataFrame, voter_file: DataFrame, prefix: str) -> DataFrame:
    """File ids of actively related people and everyone at their addresses."""
    related = edges.where("relationship_status = 'Active'").select(
        strip_prefix(F.col("state_file_id"), prefix).alias("sos_id")
    )
    return expand_by_shared_key(related, voter_file, "sos_id", "voting_address_id")


@dataclass(frozen=True)
class VoterFeedParams:
    support_question: str
    plan_question: str
    volunteer_question: str
    past_election: str


# What one row of the voter file is looked up by.
VOTER_KEYS = ["sos_id", "myv_van_id", "person_id", "master_registration_id"]


def feed_voters(
    edges: DataFrame,
    voter_file: DataFrame,
    absentee: DataFrame,
    people: DataFrame,
    external: DataFrame,
    support_names: DataFrame,
    plan_names: DataFrame,
    response_list: DataFrame,
    tiers: DataFrame,
    scores: DataFrame,
    elections: DataFrame,
    params: VoterFeedParams,
    prefix: str,
) -> DataFrame:
    """Household-expanded voters with contact data, answers, status and tier.

    Only ids of the expanded network meet the lookups, which are folded to one per
    key; the wide row of the voter file joins once, at the end. The result is
    distinct, so each lookup is made distinct before it is joined: many equal
    answers of one person do not multiply.
    """
    phones = (
        people.dropna("any", subset=["state_file_id", "phone"])
        .select(strip_prefix(F.col("state_file_id"), prefix).alias("sos_id"), "phone")
        .distinct()
    )
    support = named_answers(
        external,
        support_names,
        "master_survey_question_id",
        "master_survey_response_id",
        "msq_currency",
        params.support_question,
        "support_id",
    ).distinct()
    plan = named_answers(
        external,
        plan_names,
        "survey_question_id",
        "survey_response_id",
        "sq_currency",
        params.plan_question,
        "vote_plan",
    ).distinct()
    volunteer = latest_by_file_id(response_list, params.volunteer_question, "vol_ask", prefix).distinct()
    statuses = absentee.select("myv_van_id", raw_status().alias("voting_status")).distinct()
    past = elections.where(F.col("election_id") == params.past_election).select(
        F.col("registration_id").alias("master_registration_id")
    )
    current = voter_file.where("reg_on_current_file")
    by_file = phones.join(volunteer, "sos_id", "full")
    by_van = statuses.join(support, "myv_van_id", "full").join(plan, "myv_van_id", "full")
    by_person = tiers.select("person_id", "tier").join(scores.select("person_id", "gotv_score"), "person_id", "full")
    ids = current.select(*VOTER_KEYS).distinct().join(expanded_network(edges, voter_file, prefix), "sos_id")
    found = (
        mark_join(
            ids.join(by_file, "sos_id", "left").join(by_van, "myv_van_id", "left").join(by_person, "person_id", "left"),
            past,
            "master_registration_id",
            "voted_general",
            three_valued=True,
        )
        .distinct()
        .withColumnsRenamed({k: f"_{k}" for k in VOTER_KEYS})
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in VOTER_KEYS]
    return (
        current.join(found, same)
        .select(
            "myv_van_id",
            "last_name",
            "first_name",
            "middle_name",
            F.col("age_combined").alias("age"),
            F.col("gender_combined").alias("gender"),
            F.coalesce("phone", "primary_phone_number").alias("primary_phone_number"),
            "voting_street_address",
            "voting_street_address_2",
            "voting_city",
            "state_code",
            "voting_zip",
            "support_id",
            "vote_plan",
            "vol_ask",
            F.coalesce("voting_status", F.lit(NEEDS_TO_VOTE)).alias("voting_status"),
            "voted_general",
            "gotv_score",
            "voting_address_id",
            "household_id",
            "sos_id",
            "tier",
        )
        .distinct()
    )
