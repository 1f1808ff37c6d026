"""The state of each group on the last day, and the same from flat JSON rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.functions import ratio
from rapport.labels import ADDED_TAG, HAS_VOTED, UNMATCHED_PRIORITY, UNMATCHED_STATUS
from rapport.operators import Level, latest_one, split_join
from rapport.plans.growth import with_program
from rapport.plans.networks import TIERS, active_pairs, nonvoting_flag, tier_counts

SUPPORT_NAMES = {1: "ones", 2: "twos", 3: "threes", 4: "fours", 5: "fives"}


def group_people(edges: DataFrame, members: DataFrame, level: Level) -> DataFrame:
    """Distinct (keys, reach_id) over active relationships of members."""
    keyed = with_program(members).select("user_id", *[k for k in level.keys if k != "user_id"]).distinct()
    pairs = split_join(active_pairs(edges), keyed, "user_id").select(*level.keys, "reach_id")
    # at user level both sides, and so their join, are distinct already
    return pairs if "user_id" in level.keys else pairs.distinct()


def person_profile(
    status: DataFrame, wide: DataFrame, tiers: DataFrame, voter_file: DataFrame, crosswalk: DataFrame
) -> DataFrame:
    """One row per person: vote still open, support code, plan, tier counts."""
    answers = wide.select("reach_id", "support_id_numeric", "vote_plan")
    return (
        answers.join(nonvoting_flag(status), "reach_id", "full")
        .join(tier_counts(tiers, voter_file, crosswalk), "reach_id", "full")
    )


def _null_if_none(count: Column, value: Column) -> Column:
    """A group without any qualifying row has no figure, rather than zero."""
    return F.when(count > 0, value)


def support_histogram(people: DataFrame, keys: list[str]) -> DataFrame:
    """Support codes among a group's people; groups without a code are left out."""
    code = F.col("support_id_numeric")
    return (
        people.where(code.isNotNull())
        .groupBy(*keys)
        .agg(
            *[F.count_if(code == n).alias(f"support_id_{name}") for n, name in SUPPORT_NAMES.items()],
            F.count_if(code.between(1, 5)).alias("support_id_total"),
            F.avg(code).alias("avg_support_id"),
        )
    )


def nonvoting_rates(people: DataFrame, keys: list[str]) -> DataFrame:
    """Of a group's people whose vote is open: how many gave a code or a plan."""
    coded, planned = F.count_if(F.col("support_id_numeric").isNotNull()), F.count_if(F.col("vote_plan").isNotNull())
    n = F.count("reach_id")
    return (
        people.where("nonvoting")
        .groupBy(*keys)
        .agg(
            n.alias("num_nonvoting_voters"),
            coded.alias("nonvoting_support_ids"),
            ratio(coded, n).alias("pct_nonvoting_support_ids"),
            planned.alias("nonvoting_plans"),
            ratio(planned, n).alias("pct_nonvoting_plans"),
        )
    )


def group_figures(people: DataFrame, keys: list[str]) -> DataFrame:
    """Histogram, open-vote rates and tier counts of ``group_people`` joined with
    ``person_profile``, in one aggregate."""
    code, open_vote = F.col("support_id_numeric"), F.coalesce("nonvoting", F.lit(False))
    n_code, n_open = F.count(code), F.count_if(open_vote & F.col("reach_id").isNotNull())
    coded = F.count_if(open_vote & code.isNotNull())
    planned = F.count_if(open_vote & F.col("vote_plan").isNotNull())
    records = F.sum(F.when(open_vote, F.col("records")))
    figures = {
        **{f"support_id_{name}": _null_if_none(n_code, F.count_if(code == n)) for n, name in SUPPORT_NAMES.items()},
        "support_id_total": _null_if_none(n_code, F.count_if(code.between(1, 5))),
        "avg_support_id": F.avg(code),
        "nonvoting_support_ids": _null_if_none(n_open, coded),
        "pct_nonvoting_support_ids": ratio(coded, n_open),
        "nonvoting_plans": _null_if_none(n_open, planned),
        "pct_nonvoting_plans": ratio(planned, n_open),
        **{f"tier{t}": _null_if_none(records, F.sum(F.when(open_vote, F.col(f"tier{t}")))) for t in TIERS},
        "num_nonvoting_voters": _null_if_none(n_open, n_open),
    }
    return people.groupBy(*keys).agg(*[value.alias(name) for name, value in figures.items()])


def topline(growth: DataFrame, edges: DataFrame, members: DataFrame, profile: DataFrame, level: Level) -> DataFrame:
    """Last growth day of each group with its support, open-vote and tier figures."""
    return topline_of(growth, split_join(group_people(edges, members, level.narrow), profile, "reach_id", "left"), level)


def topline_of(growth: DataFrame, people: DataFrame, level: Level) -> DataFrame:
    """``topline`` from a group's people with their profile, by the level's narrow keys."""
    keys = list(level.narrow.keys)
    figures = group_figures(people, keys)
    last = latest_one(growth, list(level.keys), [F.col("day").desc()])
    known, new = level.all_known(), [c for c in figures.columns if c not in keys]
    return last.join(figures, keys, "left").select(*last.columns, *[F.when(known, F.col(c)).alias(c) for c in new])


def member_topline(
    user_topline: DataFrame, status: DataFrame, id_crosswalk: DataFrame, activity: DataFrame
) -> DataFrame:
    """User-level topline with the user's own voting status and last activity."""
    own = (
        id_crosswalk.select(F.col("reach_user_id").alias("user_id"), "myv_van_id")
        .join(
            status.select("myv_van_id", "voting_status_raw", "voting_status", "voting_status_priority"), "myv_van_id"
        )
        .drop("myv_van_id")
        .distinct()
    )
    return (
        user_topline.join(activity, "user_id", "left")
        .join(own, "user_id", "left")
        .withColumns(
            {
                "voting_status": F.coalesce("voting_status", F.lit(UNMATCHED_STATUS)),
                "voting_status_priority": F.coalesce("voting_status_priority", F.lit(UNMATCHED_PRIORITY)),
            }
        )
    )


SUMMARY_MEASURES = [
    "matched_voters",
    "reach_adds",
    "ids",
    "plans",
    "votes",
    *[f"support_id_{name}" for name in SUPPORT_NAMES.values()],
    "num_nonvoting_voters",
    "nonvoting_support_ids",
    "nonvoting_plans",
    *[f"tier{t}" for t in TIERS],
    "code_sum",
]


def summary_counts(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Conditional counts of flat rows per (keys, user, member-days).

    Splits a hot group over its users. A null comparison counts as false.
    """
    code = F.col("support_id_numeric")
    matched, added = F.col("sos_id") != ADDED_TAG, F.col("sos_id") == ADDED_TAG
    planned, voted = F.col("vote_plan") != "", F.col("voting_status") == HAS_VOTED
    open_vote = matched & (F.col("voting_status") != HAS_VOTED)
    counts = {
        "matched_voters": matched,
        "reach_adds": added,
        "ids": code.isNotNull(),
        "plans": planned,
        "votes": voted,
        **{f"support_id_{name}": code == n for n, name in SUPPORT_NAMES.items()},
        "num_nonvoting_voters": open_vote,
        "nonvoting_support_ids": open_vote & code.isNotNull(),
        "nonvoting_plans": open_vote & planned,
        **{f"tier{t}": F.col("tier") == str(t) for t in TIERS},
    }
    return flat.groupBy(*dict.fromkeys((*keys, "user_id", "cm_days"))).agg(
        *[F.count_if(cond).alias(name) for name, cond in counts.items()], F.sum(code).alias("code_sum")
    )


def summarise(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Summary per group from ``summary_counts`` by the same or more keys.

    Counts are brought to one row per (keys, user, member-days) first, so a user's
    member-days are added once.
    """
    unit = list(dict.fromkeys((*keys, "user_id", "cm_days")))
    numbers = SUMMARY_MEASURES
    per_user = counts.groupBy(*unit).agg(*[F.sum(c).alias(c) for c in numbers])
    c = F.col
    return (
        per_user.groupBy(*keys)
        .agg(
            F.countDistinct("user_id").alias("users"),
            *[F.sum(name).alias(name) for name in numbers],
            F.sum("cm_days").alias("_cm_days"),
        )
        .withColumns(
            {
                "pct_votes": ratio(c("votes"), c("matched_voters")),
                "pct_matched_voters": ratio(c("matched_voters"), c("matched_voters") + c("reach_adds")),
                "avg_support_id": ratio(c("code_sum"), c("ids")),
                "pct_nonvoting_support_ids": ratio(c("nonvoting_support_ids"), c("num_nonvoting_voters")),
                "pct_nonvoting_plans": ratio(c("nonvoting_plans"), c("num_nonvoting_voters")),
                "voters_per_cm_week": ratio(c("matched_voters"), c("_cm_days")) * 7,
            }
        )
        .drop("code_sum", *(["cm_days"] if "cm_days" in keys else []))
        .withColumnRenamed("_cm_days", "cm_days")
    )


def topline_summary(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Broad conditional summary of flat member/person rows.

    For several levels, store ``summary_counts`` by all their keys once and
    ``summarise`` it per level.
    """
    return summarise(summary_counts(flat, keys), keys)


MEMBER_KEYS = [
    "user_id",
    "date_joined",
    "cm_days",
    "last_activity",
    "user_name",
    "email_address",
    "phone_number",
    "rmm",
    "pod",
]


def member_summary(flat: DataFrame) -> DataFrame:
    """Summary per member with the member's own voting status."""
    own = flat.select("user_id", "cm_voting_status").distinct()
    return topline_summary(flat, MEMBER_KEYS).join(own, "user_id", "left")
