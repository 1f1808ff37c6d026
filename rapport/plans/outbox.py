"""Outbound payloads that outlive a lost response.

A batch number says nothing about what a batch holds: it changes as a key grows. Here a payload is
known by its content, and kept in an outbox until its response is in. What is on its way is left
out of new payloads, and what had no response is sent again as it was, under the same id, so that
a receiver that knows the id does nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.operators import anti, split_join
from rapport.plans.sync import STATUS_KEYS, successes, tag_payloads

OUTBOX_SCHEMA = "payload_id string, voting_status string, tag_id string, batch_size bigint, payload_json string, state string"
PENDING, CONFIRMED = "pending", "confirmed"
PEOPLE = "people array<struct<person_id:string,person_id_type:string,action:string>>"


def identified(payloads: DataFrame) -> DataFrame:
    """Payloads with ``payload_id``, a digest of tag, status and people in order of their ids.

    The order in which people were collected does not matter.
    """
    people = F.array_sort(F.from_json("payload_json", PEOPLE)["people"])
    content = F.to_json(F.struct("tag_id", "voting_status", people.alias("people")))
    return payloads.withColumn("payload_id", F.sha2(content, 256))


def unconfirmed(outbox: DataFrame) -> DataFrame:
    """Payloads to send: those without a confirming row, each once."""
    closed = outbox.where(F.col("state") == CONFIRMED).select("payload_id")
    waiting = outbox.where(F.col("state") == PENDING).dropDuplicates(["payload_id"])
    return anti(waiting, closed, ["payload_id"])


def on_the_way(outbox: DataFrame) -> DataFrame:
    """(alloy_sos_id, voting_status) of the people in unconfirmed payloads."""
    person = F.explode(F.from_json("payload_json", PEOPLE)["people"]).alias("person")
    return unconfirmed(outbox).select("voting_status", person).select(F.col("person.person_id").alias("alloy_sos_id"), "voting_status")


def enqueue(
    delta: DataFrame, outbox: DataFrame, id_type: str, n: int = 1000, action: str = "added", targets: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Outbox rows for what the delta has and no unconfirmed payload holds already.

    People that failed may come back as just the payload they were in: ids end in the number of
    times that the same content was confirmed before.
    """
    new = anti(delta.select(*STATUS_KEYS), on_the_way(outbox), STATUS_KEYS)
    rows = identified(tag_payloads(new, "voting_status", "alloy_sos_id", id_type, n, action, targets))
    closed = outbox.where(F.col("state") == CONFIRMED).select("payload_id").distinct()
    rounds = closed.groupBy(F.substring_index("payload_id", "-", 1).alias("payload_id")).agg(F.count(F.lit(1)).alias("_round"))
    rows = split_join(rows, rounds, "payload_id", "left")
    rows = rows.withColumn("payload_id", F.concat_ws("-", "payload_id", F.coalesce("_round", F.lit(0)).cast("string")))
    return rows.select("payload_id", "voting_status", "tag_id", "batch_size", "payload_json", F.lit(PENDING).alias("state"))


def confirm(outbox: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the log and for the outbox from responses (payload_id, people).

    People marked successful go to the log; those that failed come back with the next delta, as
    their payload is confirmed and the log lacks them. Responses to payloads that the outbox
    does not wait for, as for one that was confirmed before, change nothing.
    """
    answered = responses.select("payload_id", "people").dropDuplicates(["payload_id"])
    known = split_join(unconfirmed(outbox), answered, "payload_id")
    log = successes(known.select(F.col("voting_status").alias("tag"), "people"))
    closed = known.select(
        "payload_id", "voting_status", "tag_id", "batch_size", F.lit(None).cast("string").alias("payload_json"), F.lit(CONFIRMED).alias("state")
    )
    return log, closed
