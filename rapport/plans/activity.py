"""When users were last active, and what they did."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import days_between, full_name, readable_days, title_case
from rapport.labels import (
    ACTION_ANSWER,
    ACTION_CONTACT,
    ACTION_JOINED,
    ACTION_RELATIONSHIP,
    ACTION_TAG,
    ADDED_TAG,
)
from rapport.operators import split_join


def activity_days(
    users: DataFrame, actions: DataFrame, edges: DataFrame, responses: DataFrame, tags: DataFrame
) -> list[DataFrame]:
    """The five kinds of activity as (user_id, day)."""
    dated = [
        (users, "date_joined"),
        (actions, "action_date"),
        (edges, "relationship_created_date"),
        (responses.where("response_id IS NOT NULL"), "canvass_date"),
        (tags, "tag_date"),
    ]
    return [df.select("user_id", F.col(day).alias("day")) for df, day in dated]


def last_activity(sources: list[DataFrame], as_of: dt.date | Column) -> DataFrame:
    """Days since each user's last activity."""
    everything = sources[0]
    for source in sources[1:]:
        everything = everything.unionByName(source)
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    last = everything.groupBy("user_id").agg(F.max("day").alias("day"))
    return last.select("user_id", days_between(today, F.col("day")).alias("last_activity")).withColumn(
        "last_activity_readable", readable_days(F.col("last_activity"))
    )


def people_union(crosswalk: DataFrame, voter_file: DataFrame, edges: DataFrame, actions: DataFrame) -> DataFrame:
    """Names by person: title-cased from the file when matched, else as typed.

    A person typed in two ways keeps two rows.
    """
    on_file = (
        crosswalk.select("reach_id", "sos_id")
        .join(voter_file.select("sos_id", "first_name", "last_name"), "sos_id")
        .select(
            "reach_id",
            F.col("sos_id").cast("string").alias("sos_id"),
            title_case(F.col("first_name")).alias("first_name"),
            title_case(F.col("last_name")).alias("last_name"),
        )
    )

    def typed(df: DataFrame) -> DataFrame:
        return df.where("state_file_id IS NULL").select(
            "reach_id",
            F.lit(None).cast("string").alias("sos_id"),
            F.col("person_first_name").alias("first_name"),
            F.col("person_last_name").alias("last_name"),
        )

    return on_file.unionByName(typed(edges)).unionByName(typed(actions)).distinct()


def answer_text(question: Column, answer: Column, labels: dict[str, str]) -> Column:
    """'label: answer'; null for a question without a label or an empty answer."""
    label = F.coalesce(*[F.when(question == name, text) for name, text in labels.items()])
    return F.concat(label, F.lit(": "), answer)


def activity_feed(
    members: DataFrame,
    users: DataFrame,
    actions: DataFrame,
    edges: DataFrame,
    responses: DataFrame,
    tags: DataFrame,
    people: DataFrame,
    question_labels: dict[str, str],
) -> DataFrame:
    """Everything members did, with readable text and person names."""

    def event(df: DataFrame, ts: str, action: str, value: Column) -> DataFrame:
        return df.select(
            "user_id",
            "reach_id",
            F.col(ts).cast("timestamp").alias("action_timestamp"),
            F.lit(action).alias("action"),
            value.alias("value"),
        )

    inactive = F.when(F.col("relationship_status") != "Active", " (Inactive)").otherwise("")
    answered = answer_text(F.col("question_name"), F.col("response_value"), question_labels)
    events = (
        event(actions, "action_timestamp", ACTION_CONTACT, F.col("action_type"))
        .unionByName(
            event(
                edges,
                "relationship_created_timestamp",
                ACTION_RELATIONSHIP,
                F.concat(F.col("relationship_type"), inactive),
            )
        )
        .unionByName(
            event(
                responses.where("response_id IS NOT NULL"), "canvass_timestamp", ACTION_ANSWER, answered
            ).where("value IS NOT NULL")
        )
        .unionByName(event(tags, "tag_timestamp", ACTION_TAG, F.col("tag_name")))
    )
    # Joining has no person: its rows skip the name join, where they would all
    # carry the same empty key.
    joined = users.select("user_id", F.col("date_joined").cast("timestamp").alias("action_timestamp"))
    names = people.withColumnsRenamed({"first_name": "_first", "last_name": "_last"})
    columns = [*members.columns, "action_timestamp", "action", "value", "voter", "sos_id"]
    named = (
        split_join(split_join(events, members, "user_id"), names, "reach_id", "left")
        .withColumn("voter", full_name(F.col("_first"), F.col("_last")))
        .withColumn("sos_id", F.coalesce("sos_id", F.lit(ADDED_TAG)))
        .select(*columns)
    )
    joins = joined.join(members, "user_id").select(
        *members.columns,
        "action_timestamp",
        F.lit(ACTION_JOINED).alias("action"),
        F.lit(None).cast("string").alias("value"),
        F.lit("").alias("voter"),
        F.lit(None).cast("string").alias("sos_id"),
    )
    return named.unionByName(joins)
