"""Cumulative growth per group and day.

Seven measures grow over time: users, people, matched people, added people,
support answers, vote plans and votes. Relationships and person events are each
reduced to one row before they meet, every measure becomes (keys, day, n) rows
of one long table, and one aggregate per (keys, day) replaces seven joins. It folds
the days before the report and fills in empty ones, too. The windows then run over at most one row per group and day, however large a group
is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rapport.functions import days_between, greatest_strict, ratio
from rapport.labels import ADDED_TAG, MATCHED_TAG, GrowthQuestions
from rapport.operators import Level, split_join

MEASURES = ("users", "voters", "matched_voters", "reach_adds", "ids", "plans", "votes")
RATES = ("voters_per_cm_week", "pct_matched_voters", "pct_ids", "pct_plans", "pct_votes")


def with_program(members: DataFrame, program: str = "CM") -> DataFrame:
    """Members with the constant top-level group.

    Tied to the user id: joins on a bare literal would be planned without a key.
    """
    return members.withColumn("program", F.when(F.col("user_id").isNotNull(), program))


def touch_rows(edges: DataFrame) -> DataFrame:
    """Active relationships, each as a touch of its own: ``touches`` before they are reduced."""
    ts, tag = F.col("relationship_created_timestamp"), F.col("auto_applied_tag")
    return edges.where("relationship_status = 'Active'").select(
        "user_id",
        "reach_id",
        F.col("relationship_created_date").alias("first_day"),
        ts.alias("first_ts"),
        F.when(tag == MATCHED_TAG, ts).alias("matched_ts"),
        F.when(tag == ADDED_TAG, ts).alias("added_ts"),
    )


def touches(edges: DataFrame) -> DataFrame:
    """Active relationships reduced to one row per (user_id, reach_id).

    The first day is that of the earliest timestamp, the earliest of several. The
    per-tag minima tell which tags occur there.
    """
    return _earliest(touch_rows(edges), ["user_id", "reach_id"])


TIMES = ("first_ts", "matched_ts", "added_ts")


def member_minima(members: DataFrame, touched: DataFrame, level: Level) -> DataFrame:
    """One row per (keys, person): first day, first timestamp and that of each tag, from ``touches``.

    Above the user level ``touch_rows`` will do as well: each pair of user and person reduced
    before is one more shuffle and sort of all rows, which is worth it where others read it too.
    """
    keyed = members.select("user_id", *[k for k in level.keys if k != "user_id"]).distinct()
    rows = split_join(touched, keyed, "user_id")
    # At user level there is one row per (keys, person) already.
    return rows if "user_id" in level.keys else roll_up(rows, level)


def roll_up(finer: DataFrame, level: Level) -> DataFrame:
    """``member_minima`` of a level from those of one whose groups lie inside its own.

    A least timestamp is the least of the groups inside, so a coarser level never goes back to
    the relationships: each starts from as many rows as the level below has people.
    """
    return _earliest(finer, ["reach_id", *level.keys]).select(*level.keys, "reach_id", "first_day", *TIMES)


def _earliest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Least timestamps per key, and the day of the first one.

    Rows are sorted for it, so a number that parts most rows should come first among the keys.
    """
    first = F.min(F.when(F.col("first_ts").isNotNull(), F.struct("first_ts", "first_day")))
    return rows.groupBy(*keys).agg(first.getField("first_day").alias("first_day"), *[F.min(c).alias(c) for c in TIMES])


def with_tags(minima: DataFrame) -> DataFrame:
    """Whether a person's first touch in the group carries each tag, in place of the timestamps."""
    return minima.withColumns(
        {
            "is_matched": F.coalesce(F.col("matched_ts") == F.col("first_ts"), F.lit(False)),
            "is_added": F.coalesce(F.col("added_ts") == F.col("first_ts"), F.lit(False)),
        }
    ).drop(*TIMES)


def group_touches(members: DataFrame, touched: DataFrame, level: Level) -> DataFrame:
    """One row per (keys, person): the first day inside the group, and its tags."""
    rows = with_tags(member_minima(members, touched, level))
    return rows.select(*level.keys, "reach_id", "first_day", "is_matched", "is_added")


# kinds of marks a person leaves on the calendar of a group, and a member joining it
TOUCHED, ANSWERED, PLANNED, VOTED, JOINED = range(5)


def _mark(day: Column, kind: int, next_day: Column | None = None) -> Column:
    unset = F.lit(None).cast("date")
    return F.struct(
        day.alias("day"), (unset if next_day is None else next_day).alias("next_day"), F.lit(kind).alias("kind")
    )


def person_days(responses: DataFrame, votes: DataFrame, questions: GrowthQuestions) -> DataFrame:
    """One row per person with its marks: first answer day per question, and vote days.

    Vote days are distinct and know the next one, so a person's marks are bounded by
    the calendar.
    """
    ts, complete = F.col("canvass_timestamp"), F.col("response_id").isNotNull()

    def first_day(question: str) -> Column:
        asked = F.col("question_name") == question
        first, first_complete = F.min(F.when(asked, ts)), F.min(F.when(asked & complete, ts))
        day = F.min(F.when(asked & complete & ts.isNotNull(), F.struct(ts, F.col("canvass_date"))))
        # an incomplete first row hides the person's later answers
        return F.when(first == first_complete, day.getField("canvass_date"))

    answered = (
        responses.where(F.col("question_name").isin(questions.support, questions.plan))
        .groupBy("reach_id")
        .agg(first_day(questions.support).alias("id_day"), first_day(questions.plan).alias("plan_day"))
        .select(
            "reach_id", F.array(_mark(F.col("id_day"), ANSWERED), _mark(F.col("plan_day"), PLANNED)).alias("answers")
        )
    )
    following = F.lead("date_voted").over(Window.partitionBy("reach_id").orderBy("date_voted"))
    voted = (
        votes.select("reach_id", "date_voted", following.alias("next_day"))
        .groupBy("reach_id")
        .agg(F.collect_list(_mark(F.col("date_voted"), VOTED, F.col("next_day"))).alias("votes"))
    )
    return answered.join(voted, "reach_id", "full").select(
        "reach_id", F.concat(*[F.coalesce(c, F.array().cast(MARKS)) for c in ("answers", "votes")]).alias("marks")
    )


MARKS = "array<struct<day:date,next_day:date,kind:int>>"


def group_marks(members: DataFrame, people: DataFrame, level: Level) -> DataFrame:
    """What counts on each day of a group: (keys, day, kind, tags) and how often, ``n``, from its people
    with their first day, tags and marks, and from its members' joining."""
    first = F.col("first_day")
    marks = F.concat(F.array(_mark(first, TOUCHED)), F.coalesce("marks", F.array().cast(MARKS)))
    marked = people.select(*level.keys, "first_day", "is_matched", "is_added", F.explode(marks).alias("m"))
    kind, day, next_day = F.col("m.kind"), F.col("m.day"), F.col("m.next_day")
    # A vote counts on the later of its day and the first touch. Of several votes
    # before the touch, which all fall on the same day, only the last is kept.
    counted = (
        marked.where((kind != VOTED) | (day > first) | next_day.isNull() | (next_day > first))
        .withColumn("day", F.when(kind == VOTED, greatest_strict(first, day)).otherwise(day))
        .select(*level.keys, "day", kind.alias("kind"), "is_matched", "is_added")
    )
    if "user_id" in level.keys:
        # a user has few marks on a day: counting them before would shuffle nearly all of them once more
        counted = counted.withColumn("n", F.lit(1).cast("bigint"))
    else:
        counted = counted.groupBy(*counted.columns).agg(F.count(F.lit(1)).alias("n"))
    joined = (
        members.select(*dict.fromkeys((*level.keys, "user_id")), F.col("date_joined").alias("day"))
        .distinct()
        .withColumn("kind", F.when(F.col("user_id").isNotNull(), JOINED))
        .select(*level.keys, "day", "kind", *[F.lit(False).alias(c) for c in ("is_matched", "is_added")])
        .withColumn("n", F.lit(1).cast("bigint"))
    )
    return counted.unionByName(joined).where("day IS NOT NULL")


def _counts() -> list[Column]:
    """Each measure over ``group_marks``; null where it has nothing."""
    kind = F.col("kind")
    counts = {
        "users": kind == JOINED,
        "voters": kind == TOUCHED,
        "matched_voters": (kind == TOUCHED) & F.col("is_matched"),
        "reach_adds": (kind == TOUCHED) & F.col("is_added"),
        "ids": kind == ANSWERED,
        "plans": kind == PLANNED,
        "votes": kind == VOTED,
    }
    return [F.sum(F.when(counts[m], F.col("n"))).alias(m) for m in MEASURES]


def daily_counts(marks: DataFrame, level: Level) -> DataFrame:
    """New counts per (keys, day) from ``group_marks``; null where a measure has nothing that day."""
    return marks.groupBy(*level.keys, "day").agg(*_counts())


def _calendar(groups: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    step = F.expr("interval 1 day")
    return groups.withColumn("day", F.explode(F.sequence(F.lit(first), F.lit(last), step)))


def _running(keys: tuple[str, ...]):
    return Window.partitionBy(*keys).orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)


def dense_totals(
    members: DataFrame, marks: DataFrame, level: Level, start: dt.date, report_start: dt.date, as_of: dt.date
) -> DataFrame:
    """Running totals over every calendar day, cut to the report days at the end."""
    groups = members.select(*level.keys).distinct()
    w = _running(level.keys)
    return (
        _calendar(groups, start, as_of)
        .join(daily_counts(marks, level), [*level.keys, "day"], "left")
        .select(*level.keys, "day", *[F.sum(m).over(w).alias(m) for m in MEASURES])
        .withColumn("cm_days", F.sum("users").over(w))
        .where(F.col("day") >= F.lit(report_start))
    )


def sparse_totals(
    members: DataFrame, marks: DataFrame, level: Level, start: dt.date, report_start: dt.date, as_of: dt.date
) -> DataFrame:
    """The same totals over report days only.

    Earlier days are folded onto the first report day as an opening balance, before anything
    is counted. Member-days follow from two running sums over the join days j:
    ``sum(n_j * (d - j + 1)) = (d + 1) * sum(n_j) - sum(n_j * j)``.
    """
    offset = days_between(F.col("day"), F.lit(start))
    # a null key matches no group
    folded = (
        marks.where(F.col("day").between(F.lit(start), F.lit(as_of)))
        .dropna("any", subset=list(level.keys))
        .withColumn("_j", F.when(F.col("kind") == JOINED, offset * F.col("n")))
        .withColumn("day", F.greatest(F.col("day"), F.lit(report_start)))
    )
    groups = members.select(*level.keys).distinct()
    # Report days come in as rows without a kind: one aggregate counts and fills in empty days.
    each_day = (
        _calendar(groups, report_start, as_of)
        .unionByName(folded, allowMissingColumns=True)
        .groupBy(*level.keys, "day")
        .agg(*_counts(), F.sum("_j").alias("_nj"))
    )
    w = _running(level.keys)
    total = F.sum("users").over(w)
    return each_day.select(
        *level.keys,
        "day",
        *[F.sum(m).over(w).alias(m) for m in MEASURES],
        ((offset + 1) * total - F.sum("_nj").over(w)).alias("cm_days"),
    )


def growth_rates(totals: DataFrame) -> DataFrame:
    """Rates over the cumulative values."""
    c = F.col
    return totals.withColumns(
        {
            "voters_per_cm_week": ratio(c("matched_voters"), c("cm_days")) * 7,
            "pct_matched_voters": ratio(c("voters") - F.coalesce("reach_adds", F.lit(0)), c("voters")),
            "pct_ids": ratio(c("ids"), c("voters")),
            "pct_plans": ratio(c("plans"), c("voters")),
            "pct_votes": ratio(c("votes"), c("voters")),
        }
    )


def with_today(rates: DataFrame, level: Level, as_of: dt.date, metrics=("voters_per_cm_week", "pct_votes")) -> DataFrame:
    """Each group's value on ``as_of`` attached to all its rows."""
    w = Window.partitionBy(*level.keys)
    today = F.col("day") == F.lit(as_of)
    return rates.withColumns({f"todays_{m}": F.max(F.when(today, F.col(m))).over(w) for m in metrics})


def series(
    members: DataFrame,
    touched: DataFrame,
    days: DataFrame,
    level: Level,
    start: dt.date,
    report_start: dt.date,
    as_of: dt.date,
    form: str = "sparse",
) -> DataFrame:
    """The growth series from ``touches`` and ``person_days``, which all levels share:
    store them once when building several levels."""
    members, inner = with_program(members), level.narrow
    people = split_join(group_touches(members, touched, inner), days, "reach_id", "left")
    return series_of(members, group_marks(members, people, inner), level, start, report_start, as_of, form)


def series_of(
    members: DataFrame, marks: DataFrame, level: Level, start: dt.date, report_start: dt.date, as_of: dt.date, form: str = "sparse"
) -> DataFrame:
    """The growth series from its ``group_marks`` by the level's narrow keys."""
    members = with_program(members)
    inner = level.narrow
    totals = {"sparse": sparse_totals, "dense": dense_totals}[form]
    out = with_today(growth_rates(totals(members, marks, inner, start, report_start, as_of)), inner, as_of)
    return with_user_columns(out, members, level)


def with_user_columns(per_user: DataFrame, members: DataFrame, level: Level) -> DataFrame:
    """Attach a user level's other keys to a series built by user id alone; others are as they were.

    A user listed under two leaders has the same series twice. A group with a null
    key has no figures, as a null key matches nothing.
    """
    if level.narrow == level:
        return per_user
    groups = members.select(*level.keys).distinct()
    known = level.all_known()
    figures = [c for c in per_user.columns if c not in ("user_id", "day")]
    return per_user.join(groups, "user_id").select(
        *level.keys, "day", *[F.when(known, F.col(c)).alias(c) for c in figures]
    )


def growth_series(
    members: DataFrame,
    edges: DataFrame,
    responses: DataFrame,
    votes: DataFrame,
    level: Level,
    questions: GrowthQuestions,
    start: dt.date,
    report_start: dt.date,
    as_of: dt.date,
    form: str = "sparse",
) -> DataFrame:
    """Cumulative measures, member-days, rates and today's values per report day."""
    days = person_days(responses, votes, questions)
    return series(members, touches(edges), days, level, start, report_start, as_of, form)
