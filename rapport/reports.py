"""All reports over one set of input tables.

``Reports`` wires the plan functions together: each shared view is built once and
reused, and nothing runs until a report is written or read. ``write_reports``
stores the views that several reports read and writes one output per report.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Iterable
from copy import copy
from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rapport import operators as ops
from rapport.labels import GrowthQuestions, ScoreRules, SupportCodes, TierRules
from rapport.operators import split_join
from rapport.plans import activity, answers, feeds, growth, lists, members, networks, queues, status, sync, tiers, topline
from rapport.sources import sinks, tables


@dataclass(frozen=True)
class Params:
    """Ids, codes, texts and days that differ from one programme to the next."""

    as_of: dt.date
    calendar_start: dt.date
    report_start: dt.date
    scores: ScoreRules
    codes: SupportCodes
    questions: GrowthQuestions
    question_labels: dict[str, str]
    tag_ids: dict[str, str]
    groups: dict[str, str]
    voter_feed: feeds.VoterFeedParams
    home_state: str
    uncontactable_tag: str
    note_category: str
    # what an external id starts with, before the file's own id
    prefix: str
    person_id_type: str = "State File ID"
    # the name a tag's payloads carry, by tag id; the status where none is given
    tag_names: dict[str, str] = field(default_factory=dict)
    # the sheet's own row order, and what makes the latest tag row definite
    sheet_order: str = "row_no"
    tag_order: tuple[str, ...] = ("tag_timestamp",)
    levels: tuple[ops.Level, ...] = field(default=ops.LEVELS)


class view:
    """A view several reports read: built once per ``Reports``, with a count of its reads."""

    def __init__(self, build: Callable[[Reports], DataFrame]):
        self.build, self.name, self.__doc__ = build, build.__name__, build.__doc__

    def __get__(self, reports: Reports | None, owner: type) -> DataFrame | view:
        if reports is None:
            return self
        reports.reads[self.name] += 1
        if self.name not in reports.built:
            reports.built[self.name] = reports.planned(self.build(reports))
        return reports.built[self.name]


class Reports:
    """Views and reports by name; ``table`` gives an input table by name."""

    def __init__(self, table: Callable[[str], DataFrame], params: Params):
        self._table, self.params = table, params
        self._tables: dict[str, DataFrame] = {}
        self.built: dict[str, DataFrame] = {}
        self.reads: Counter[str] = Counter()
        self.copies: list[tuple[SparkSession, str]] = []
        # Whether people carry their profiles: worth it where toplines read them.
        self.profiles = False
        # On the side only: views are planned to count who reads them, one at a time.
        self.counting = False
        # Names of the views that are stored.
        self.kept: set[str] = set()

    @classmethod
    def over(cls, spark: SparkSession, root: str, params: Params) -> Reports:
        """Reports over Parquet tables below one folder."""
        return cls(lambda name: tables.load(spark, root, name), params)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._table(name)
        return self._tables[name]

    def planned(self, df: DataFrame) -> DataFrame:
        """A view as its readers see it: while reads are counted only its columns, so that plans stay short."""
        return df.sparkSession.createDataFrame([], df.schema) if self.counting else df

    def store(self, *names: str) -> None:
        """Replace shared views by stored copies, for when several reports read them."""
        for name in names:
            df = self.shared(name)
            path = sinks.scratch(df.sparkSession, name)
            self.built[name] = sinks.stored_at(df, path)
            self.copies.append((df.sparkSession, path))
            self.kept.add(name)

    def shared(self, name: str) -> DataFrame:
        """A shared view by name, also those of a level."""
        if not name.startswith(PEOPLE):
            return getattr(self, name)
        return self.people_at(next(level for level in self.params.levels if PEOPLE + level.name == name))

    def prepare(self, *names: str) -> None:
        """Store the views that building these reports reads more than once.

        The reports are planned on the side to count the reads; the plans of ``REREAD``
        views' readers read them several times themselves. A view is stored after those it
        reads itself, which then come from their copies.
        """
        self.profiles = any(name.startswith("topline_") for name in names)
        trial = copy(self)
        trial.built, trial.reads = dict(self.built), Counter()
        trial.counting = True
        trial.kept = {PEOPLE + level.name for level in self.params.levels}
        builders = trial.by_name()
        for name in names:
            builders[name]()
        shared = (*SHARED, *[PEOPLE + level.name for level in self.params.levels])
        wanted = [name for name in shared if trial.reads[name] > (name not in REREAD)]
        self.store(*[name for name in wanted if name not in self.built])

    def clear(self) -> None:
        """Delete the stored copies; what was built on them cannot be read any more."""
        for spark, path in self.copies:
            sinks.delete(spark, path)
        self.copies.clear()
        self.built.clear()
        self.kept.clear()

    # --- shared views ----------------------------------------------------------------

    @view
    def members(self) -> DataFrame:
        return members.match_members(self.table("training_tracker"), self.table("leader_codes"), self.table("users"))

    @view
    def status(self) -> DataFrame:
        return status.vote_status(self.table("crosswalk"), self.table("voter_file"), self.table("absentee"))

    @view
    def votes(self) -> DataFrame:
        return status.vote_days(self.table("crosswalk"), self.table("voter_file"), self.table("absentee"))

    @view
    def answers(self) -> DataFrame:
        return answers.latest_answers(self.table("responses"), self.table("survey_defs"), self.params.scores)

    @view
    def wide(self) -> DataFrame:
        return answers.wide_answers(self.answers)

    @view
    def tiers(self) -> DataFrame:
        return tiers.voter_tiers(
            self.table("voter_file"),
            self.table("absentee"),
            self.table("scores"),
            self.table("external_responses"),
            self.answers,
            self.table("crosswalk"),
            TierRules(self.params.codes),
        )

    @view
    def person_tier(self) -> DataFrame:
        return networks.tier_by_person(self.tiers, self.table("voter_file"), self.table("crosswalk"))

    @view
    def profile(self) -> DataFrame:
        return topline.person_profile(
            self.status, self.wide, self.tiers, self.table("voter_file"), self.table("crosswalk")
        )

    @view
    def id_crosswalk(self) -> DataFrame:
        return lists.id_crosswalk(self.table("notes"), self.table("person_records"), self.params.note_category)

    @view
    def activity(self) -> DataFrame:
        inputs = ("users", "contact_actions", "relationships", "responses", "tag_history")
        return activity.last_activity(activity.activity_days(*map(self.table, inputs)), self.params.as_of)

    @view
    def people(self) -> DataFrame:
        inputs = ("crosswalk", "voter_file", "relationships", "contact_actions")
        return activity.people_union(*map(self.table, inputs))

    @view
    def touched(self) -> DataFrame:
        return growth.touches(self.table("relationships"))

    @view
    def days(self) -> DataFrame:
        return growth.person_days(self.table("responses"), self.votes, self.params.questions)

    @view
    def facts(self) -> DataFrame:
        """One row per person with all that the wanted reports count; profiles only if a topline is wanted."""
        if not self.profiles:
            return self.days
        return self.days.join(self.profile, "reach_id", "full")

    def people_at(self, level: ops.Level) -> DataFrame:
        """A level's people: one row per (narrow keys, person) with the first touch and its tags, and ``facts``.

        Levels form a cascade: where a finer level's people are stored and its groups lie inside
        this one's, they are the start; else the relationships are.
        """
        name = PEOPLE + level.name
        self.reads[name] += 1
        if name not in self.built:
            keys = self.grouped(level.narrow)
            finer = self.finer(level)
            if finer:
                minima = growth.roll_up(self.people_at(finer), keys)
            else:
                minima = growth.member_minima(growth.with_program(self.members), self.touches_for(keys), keys)
            self.built[name] = self.planned(split_join(minima, self.facts, "reach_id", "left"))
        return self.built[name]

    def touches_for(self, level: ops.Level) -> DataFrame:
        """First touches per user and person if the level is of users or a copy of them is there, else every touch."""
        if "user_id" in level.keys or self.counting or "touched" in self.kept:
            return self.touched
        return growth.touch_rows(self.table("relationships"))

    def finer(self, level: ops.Level) -> ops.Level | None:
        """The nearest level before this one whose groups lie inside this one's and whose people are stored."""
        levels = list(self.params.levels)
        for before in reversed(levels[: levels.index(level)] if level in levels else []):
            if PEOPLE + before.name in self.kept and "user_id" not in before.keys and set(level.keys) <= set(self.grouped(before).keys):
                return before
        return None

    def grouped(self, level: ops.Level) -> ops.Level:
        """A level with the constant keys of coarser ones: they part no group, and the cascade needs them."""
        constant = [] if "user_id" in level.keys else [k for k in CONSTANT if any(k in other.keys for other in self.params.levels)]
        return ops.Level(level.name, tuple(dict.fromkeys((*level.keys, *constant))))

    @view
    def segments(self) -> DataFrame:
        return lists.user_segments(self.table("users"), self.members, self.params.home_state, self.params.groups)

    @view
    def support(self) -> DataFrame:
        return lists.support_scores(self.table("external_responses"), self.table("scores"), self.params.codes)

    @view
    def delta(self) -> DataFrame:
        return sync.status_delta(
            self.table("absentee"),
            self.table("voter_file"),
            self.table("tag_history"),
            self.table("tag_log"),
            self.params.tag_ids,
            self.tag_order(),
            self.params.prefix,
        )

    def tag_order(self) -> list[Column]:
        return [F.col(c).desc() for c in self.params.tag_order]

    # --- reports ------------------------------------------------------------------------

    def growth(self, level: ops.Level, form: str = "sparse") -> DataFrame:
        if form == "sparse" and f"growth_{level.name}" in self.built:
            return self.built[f"growth_{level.name}"]
        return growth.with_user_columns(self.narrow_growth(level, form), self.members, level)

    def narrow_growth(self, level: ops.Level, form: str = "sparse") -> DataFrame:
        """``growth`` by the level's narrow keys."""
        p = self.params
        people = growth.with_tags(self.people_at(level))
        marks = growth.group_marks(growth.with_program(self.members), people, level.narrow)
        return growth.series_of(self.members, marks, level.narrow, p.calendar_start, p.report_start, p.as_of, form)

    def topline(self, level: ops.Level) -> DataFrame:
        people = self.people_at(level)
        if "nonvoting" not in people.columns:
            people = split_join(people, self.profile, "reach_id", "left")
        if f"growth_{level.name}" in self.built:
            return topline.topline_of(self.growth(level), people, level)
        # the last day is taken before a user's other columns are attached to every day
        last = topline.topline_of(self.narrow_growth(level), people, level.narrow)
        return growth.with_user_columns(last, self.members, level)

    def member_topline(self) -> DataFrame:
        return topline.member_topline(
            self.topline(self.params.levels[0]), self.status, self.id_crosswalk, self.activity
        )

    def match_errors(self) -> DataFrame:
        return members.match_errors(
            self.table("training_tracker"), self.table("leader_codes"), self.table("users"), self.params.sheet_order
        )

    def activity_feed(self) -> DataFrame:
        inputs = ("users", "contact_actions", "relationships", "responses", "tag_history")
        return activity.activity_feed(
            self.members, *map(self.table, inputs), self.people, self.params.question_labels
        )

    def work_queue(self) -> DataFrame:
        return queues.work_queue(
            self.table("relationships"), self.members, self.wide, self.status, self.person_tier
        )

    def network_scores(self) -> DataFrame:
        return networks.network_scores(
            self.table("relationships"),
            self.table("crosswalk"),
            self.table("voter_file"),
            self.table("absentee"),
            self.tiers,
        )

    def volunteer_users(self) -> DataFrame:
        return queues.volunteer_users(self.table("users"), self.members, self.table("relationships"), self.status)

    def volunteer_people(self) -> DataFrame:
        return queues.volunteer_people(self.table("relationships"), self.members, self.wide, self.status)

    def feed_relationships(self) -> DataFrame:
        return feeds.feed_relationships(self.table("relationships"), self.params.prefix)

    def feed_users(self) -> DataFrame:
        return feeds.feed_users(self.table("users"), self.table("relationships"), self.id_crosswalk, self.members)

    def feed_voters(self) -> DataFrame:
        return feeds.feed_voters(
            self.table("relationships"),
            self.table("voter_file"),
            self.table("absentee"),
            self.table("people"),
            self.table("external_responses"),
            self.table("support_names"),
            self.table("plan_names"),
            self.table("response_list"),
            self.tiers,
            self.table("scores"),
            self.table("election_voted"),
            self.params.voter_feed,
            self.params.prefix,
        )

    def not_enrolled(self) -> DataFrame:
        return lists.not_enrolled(self.table("users"), self.table("notes"), self.params.note_category)

    def uncontactable(self) -> DataFrame:
        return lists.uncontactable(
            self.status,
            self.table("voter_file"),
            self.table("crosswalk"),
            self.table("phone_numbers"),
            self.support,
            self.table("tag_history"),
            self.params.uncontactable_tag,
            self.params.prefix,
        )

    def tag_payloads(self) -> DataFrame:
        targets = {status: (tag, self.params.tag_names.get(tag, status)) for tag, status in self.params.tag_ids.items()}
        return sync.tag_payloads(
            self.delta, "voting_status", "alloy_sos_id", self.params.person_id_type, targets=targets
        )

    def group_payloads(self) -> DataFrame:
        return sync.group_payloads(self.segments)

    def by_name(self) -> dict[str, Callable[[], DataFrame]]:
        """Every report and view that is written out, by output name."""
        first, rest = self.params.levels[0], self.params.levels[1:]
        views = ("members", "status", "answers", "wide", "tiers", "id_crosswalk", "activity", "segments", "delta")
        named = ("match_errors", "activity_feed", "work_queue", "network_scores", "volunteer_users", "volunteer_people")
        lists_ = ("feed_relationships", "feed_users", "feed_voters", "not_enrolled", "uncontactable")
        return {
            **{name: lambda name=name: getattr(self, name) for name in views},
            **{f"growth_{level.name}": lambda level=level: self.growth(level) for level in self.params.levels},
            **{f"topline_{level.name}": lambda level=level: self.topline(level) for level in rest},
            f"topline_{first.name}": self.member_topline,
            **{name: getattr(self, name) for name in (*named, *lists_, "tag_payloads", "group_payloads")},
        }


# Views worth a stored copy when they are read more than once, each after those it reads.
SHARED = (
    "members",
    "status",
    "votes",
    "answers",
    "wide",
    "tiers",
    "person_tier",
    "profile",
    "touched",
    "days",
    "facts",
    "id_crosswalk",
    "activity",
    "people",
    "segments",
    "delta",
)

# Views that growth goes through once per measure.
REREAD = ("members",)
# What the names of the levels' people begin with, and keys that are the same for everyone.
PEOPLE, CONSTANT = "people_", ("program",)

# How reports are sorted when they are written.
ORDER = {
    "activity_feed": lambda p: [F.col("action_timestamp").desc(), "user_id", "voter"],
    "volunteer_people": lambda p: ["user_name", "user_id", "reach_id"],
    "match_errors": lambda p: [F.col(p.sheet_order).desc()],
}


def write_reports(reports: Reports, root: str, names: Iterable[str] | None = None) -> dict[str, str]:
    """Write reports (all of them unless named) below ``root`` and return their paths.

    Views that the wanted reports read more than once are stored first and deleted at the
    end. A written growth series is read back by the topline of its level.
    """
    wanted = list(reports.by_name()) if names is None else list(names)
    builders = reports.by_name()
    try:
        reports.prepare(*wanted)
        paths = {}
        for name in wanted:
            df = builders[name]()
            order = ORDER[name](reports.params) if name in ORDER else None
            paths[name] = sinks.write_report(df, root, name, order=order)
            if name.startswith("growth_"):
                reports.built[name] = df.sparkSession.read.schema(df.schema).parquet(paths[name])
        return paths
    finally:
        reports.clear()
