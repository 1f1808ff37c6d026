"""Nested organisation documents to flat rows and back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.functions import days_between, to_int
from rapport.operators import collect_batches
from rapport.schemas import MEMBER, PERSON, VOLUNTEER, VOLUNTEER_PERSON

MEMBER_FIELDS = [f.name for f in MEMBER.fields if f.name != "network"]
PERSON_FIELDS = list(PERSON.names)
VOLUNTEER_FIELDS = [f.name for f in VOLUNTEER.fields if f.name != "network"]
VOLUNTEER_PERSON_FIELDS = list(VOLUNTEER_PERSON.names)


def flatten_org(docs: DataFrame, until: dt.date) -> DataFrame:
    """One row per (pod, leader, member, person). Empty networks give no row.

    The member's own status is renamed first: people have a status as well.
    """
    own = {"voting_status": "cm_voting_status"}
    return (
        docs.select(F.explode("doc").alias("pod", "leaders"))
        .select("pod", F.explode("leaders").alias("leader"))
        .select("pod", "leader.rmm", F.explode("leader.cms").alias("cm"))
        .select("pod", "rmm", *[F.col(f"cm.{c}").alias(own.get(c, c)) for c in MEMBER_FIELDS], "cm.network")
        .withColumn("person", F.explode("network"))
        .select("*", "person.*")
        .drop("network", "person")
        .withColumns(
            {
                "date_joined": F.col("date_joined").try_cast("date"),
                "support_id_numeric": to_int(F.col("support_id_numeric")),
            }
        )
        .withColumn("cm_days", days_between(F.lit(until), F.col("date_joined")))
    )


def nest_networks(flat: DataFrame, max_people: int = 1000) -> DataFrame:
    """Organisation documents, one line each, holding at most ``max_people`` of one member.

    A member may know very many people, so a network is spread over as many
    documents as it needs; flattening them gives all rows back.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in PERSON_FIELDS]
    member = ["pod", "rmm", *[c if c != "voting_status" else "cm_voting_status" for c in MEMBER_FIELDS]]
    rows = flat.select(*member, F.struct(*text).alias("person")).withColumns(
        {"_person_key": F.xxhash64("person"), "_member_key": F.xxhash64(*member)}
    )
    parts = collect_batches(
        rows, "_member_key", "_person_key", F.col("person"), "network", max_people, tuple(member), repeated=True
    )
    own = [F.col("cm_voting_status" if c == "voting_status" else c).cast("string").alias(c) for c in MEMBER_FIELDS]
    leader = F.struct("rmm", F.array(F.struct(*own, "network")).alias("cms"))
    return parts.select(F.create_map("pod", F.array(leader)).alias("doc"))


def org_lines(docs: DataFrame) -> DataFrame:
    """Documents as JSON text, one per line, for ``write.text``."""
    return docs.select(F.to_json("doc").alias("value"))


def flatten_volunteers(docs: DataFrame) -> DataFrame:
    """One row per (volunteer, person)."""
    return (
        docs.select(F.explode("doc.users").alias("user"))
        .select(*[F.col(f"user.{c}") for c in VOLUNTEER_FIELDS], F.explode("user.network").alias("person"))
        .select("*", "person.*")
        .drop("person")
        .withColumn("date_joined", F.col("date_joined").try_cast("date"))
    )


def nest_volunteers(flat: DataFrame, max_people: int = 1000) -> DataFrame:
    """Volunteer documents with at most ``max_people`` of one volunteer each."""
    person = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in VOLUNTEER_PERSON_FIELDS]
    rows = flat.select(*VOLUNTEER_FIELDS, F.struct(*person).alias("person")).withColumns(
        {"_person_key": F.xxhash64("person"), "_user_key": F.xxhash64(*VOLUNTEER_FIELDS)}
    )
    parts = collect_batches(
        rows, "_user_key", "_person_key", F.col("person"), "network", max_people, tuple(VOLUNTEER_FIELDS), repeated=True
    )
    user = F.struct(*[F.col(c).cast("string").alias(c) for c in VOLUNTEER_FIELDS], "network")
    return parts.select(F.struct(F.array(user).alias("users")).alias("doc"))


def volunteer_summary(flat: DataFrame) -> DataFrame:
    """Network figures per volunteer from flat rows."""
    keys = ["user_id", "user_name", "phone_number", "date_joined", "zip_code", "state"]
    return (
        flat.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("voters"),
            F.count_if(F.col("auto_applied_tag") == "Voter").alias("matched_voters"),
            F.count_if(F.col("voting_status") == "Has Voted!").alias("voters_voted"),
            F.count_if(F.col("only_reachable_by_reacher") == "y").alias("voters_uncontactable"),
        )
        .select(
            "user_id",
            "user_name",
            "phone_number",
            "date_joined",
            "voters",
            "matched_voters",
            "voters_voted",
            "voters_uncontactable",
            "zip_code",
            "state",
        )
    )


def volunteer_list(flat: DataFrame) -> DataFrame:
    """Every volunteer's people."""
    columns = ["reach_id", "user_id", "user_name", *VOLUNTEER_PERSON_FIELDS[1:]]
    return flat.select(*columns)


def member_list(flat: DataFrame) -> DataFrame:
    """Every member's people with answers, status and tier."""
    return flat.select(
        "user_id",
        "voter",
        "user_name",
        "email_address",
        "phone_number",
        "date_joined",
        "rmm",
        "pod",
        "support_id",
        "support_id_numeric",
        "vote_plan",
        "detailed_plan",
        "vol_ask",
        "triplers",
        "outreach",
        "sos_id",
        "voting_status",
        "tier",
        "tier_str",
    )
