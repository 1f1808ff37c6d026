"""Idempotent status sync: what is not tagged yet, in batches, and the success log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import add_prefix
from rapport.labels import STATUS_STEPS
from rapport.operators import anti, collect_batches, latest_one, payloads
from rapport.plans.status import tag_status

STATUS_KEYS = ["alloy_sos_id", "voting_status"]
# Action flags and the state of a person in a bulk response.
ACTIONS = ("added", "removed")
SUCCESS = "success"


def latest_tags(tags: DataFrame, order: list[Column]) -> DataFrame:
    """Latest history row per (person, tag)."""
    return latest_one(tags, ["reach_id", "tag_id"], order)


def current_statuses(absentee: DataFrame, voter_file: DataFrame, prefix: str) -> DataFrame:
    """Tag-form status per external id, for people with any status date."""
    return (
        absentee.where(" OR ".join(f"{day} IS NOT NULL" for day, _, _ in STATUS_STEPS))
        .join(voter_file.select("myv_van_id", "sos_id"), "myv_van_id")
        .select(add_prefix(F.col("sos_id"), prefix).alias("alloy_sos_id"), tag_status().alias("voting_status"))
    )


def present_statuses(tags: DataFrame, log: DataFrame, tag_ids: dict[str, str], order: list[Column]) -> DataFrame:
    """Statuses already tagged: latest history row 'Added', or logged as sent."""
    name = F.coalesce(*[F.when(F.col("tag_id") == tag, status) for tag, status in tag_ids.items()])
    tagged = (
        latest_tags(tags, order)
        .where("tag_action = 'Added'")
        .select(F.col("state_file_id").alias("alloy_sos_id"), name.alias("voting_status"))
    )
    return tagged.unionByName(log.select(*STATUS_KEYS)).dropna("any").distinct()


def status_delta(
    absentee: DataFrame,
    voter_file: DataFrame,
    tags: DataFrame,
    log: DataFrame,
    tag_ids: dict[str, str],
    order: list[Column],
    prefix: str,
) -> DataFrame:
    """Current statuses that are neither in the tag history nor in the log."""
    current = current_statuses(absentee, voter_file, prefix)
    return anti(current, present_statuses(tags, log, tag_ids, order), STATUS_KEYS)


def tag_payloads(
    delta: DataFrame,
    key: str,
    id: str,
    id_type: str,
    n: int = 1000,
    action: str = "added",
    targets: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Bulk-update payloads of at most ``n`` people per status.

    ``targets`` maps a status to the tag id the payload is sent to and its tag name.
    """
    if action not in ACTIONS:
        raise ValueError(f"action must be one of {ACTIONS}")
    person = F.struct(
        F.col(id).alias("person_id"), F.lit(id_type).alias("person_id_type"), F.lit(action).alias("action")
    )
    return payloads(delta.select(key, id).distinct(), key, id, person, n, targets=targets)


def successes(results: DataFrame) -> DataFrame:
    """Log rows for the people a bulk response marked successful; none if it had none."""
    return (
        results.select("tag", F.explode("people").alias("person"))
        .where(F.col("person.status") == SUCCESS)
        .select(F.col("person.person_id").alias("alloy_sos_id"), F.col("tag").alias("voting_status"))
    )


def last_labels(sheet: DataFrame, id: str, label: str, order: list[Column]) -> DataFrame:
    """Label of each id where the last row wins, as (label, id) rows."""
    named = sheet.where(F.col(id).isNotNull() & (F.trim(F.col(id).cast("string")) != ""))
    return latest_one(named, [id], order).select(label, id)


def group_payloads(segments: DataFrame, n: int = 1000) -> DataFrame:
    """Group membership in batches; a receiver applies all ``n_batches`` of a group together."""
    batches = collect_batches(segments, "group_id", "user_id", F.struct("user_id"), "_users", n)
    per_group = batches.groupBy(F.col("group_id").alias("_group")).agg(F.count(F.lit(1)).alias("n_batches"))
    return batches.join(per_group, F.col("group_id").eqNullSafe(F.col("_group"))).select(
        "group_id",
        "batch_no",
        "n_batches",
        "batch_size",
        F.to_json(F.struct(F.col("_users").alias("users"))).alias("payload_json"),
    )
