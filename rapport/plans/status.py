"""Where a person stands in the voting process."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.labels import (
    HAS_VOTED,
    MAILED_RAW,
    NEEDS_TO_RETURN,
    NEEDS_TO_VOTE,
    STATUS_STEPS,
    VOTED_RAW,
)


def raw_status(default: str | None = NEEDS_TO_VOTE) -> Column:
    """Label of the first status date present."""
    labels = [F.when(F.col(day).isNotNull(), label) for day, label, _ in STATUS_STEPS]
    return F.coalesce(*labels, F.lit(default).cast("string"))


def tag_status() -> Column:
    """The same ladder in tag form, null when no date is present."""
    return F.coalesce(*[F.when(F.col(day).isNotNull(), tag) for day, _, tag in STATUS_STEPS])


def grouped_status(raw: Column) -> Column:
    return (
        F.when(raw.isin(*VOTED_RAW), HAS_VOTED).when(raw == MAILED_RAW, NEEDS_TO_RETURN).otherwise(NEEDS_TO_VOTE)
    )


def status_priority(raw: Column) -> Column:
    return F.when(raw.isin(*VOTED_RAW), 10).when(raw == MAILED_RAW, 3).otherwise(1)


def vote_status(crosswalk: DataFrame, voter_file: DataFrame, absentee: DataFrame) -> DataFrame:
    """One row per (person id, file record, absentee row) on the current file."""
    current = voter_file.where("reg_on_current_file").select("sos_id", "myv_van_id")
    raw = F.col("voting_status_raw")
    return (
        crosswalk.select("reach_id", "sos_id")
        .join(current, "sos_id")
        .join(absentee, "myv_van_id", "left")
        .select("reach_id", "sos_id", "myv_van_id", raw_status().alias("voting_status_raw"))
        .withColumns({"voting_status": grouped_status(raw), "voting_status_priority": status_priority(raw)})
    )


def vote_days(crosswalk: DataFrame, voter_file: DataFrame, absentee: DataFrame) -> DataFrame:
    """Distinct (reach_id, date_voted) of people with a vote date."""
    voted = absentee.select(
        "myv_van_id", F.coalesce("date_early_voted", "date_ballot_received").alias("date_voted")
    ).dropna("any")
    return (
        crosswalk.select("reach_id", "sos_id")
        .join(voter_file.select("sos_id", "myv_van_id"), "sos_id")
        .join(voted, "myv_van_id")
        .select("reach_id", "date_voted")
        .distinct()
    )


def voted_sets(absentee: DataFrame, voter_file: DataFrame) -> DataFrame:
    """Per person over all absentee rows: voted, or a ballot pending without a vote."""
    last = {
        name: F.max(name)
        for name in ("date_early_voted", "date_ballot_received", "date_request_received", "date_ballot_mailed")
    }
    voted = F.coalesce(last["date_early_voted"], last["date_ballot_received"]).isNotNull()
    asked = F.coalesce(last["date_request_received"], last["date_ballot_mailed"]).isNotNull()
    return (
        absentee.join(voter_file.select("myv_van_id", "person_id"), "myv_van_id")
        .groupBy("person_id")
        .agg(voted.alias("voted"), (~voted & asked).alias("pending"))
    )
