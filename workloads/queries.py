"""One query per operator and report, over whole tables of a data folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import rapport.functions as fn
from rapport import operators as ops
from rapport.labels import STATUS_STEPS, GrowthQuestions, ScoreRules, SupportCodes
from rapport.plans import answers, feeds, growth, members, nested, outbox, status, sync, templates, tiers, topline
from rapport.reports import Params, Reports, view
from rapport.schemas import ORG, TABLES
from rapport.sources import files, layout, pretty, sheets, sinks, tables
from rapport.streaming.latest import read_latest, stream_latest
from rapport.streaming.sync import read_log, stream_delta
from workloads.roles import AS_OF, BASE, CALENDAR_START, FLAT, HOME_STATE, PREFIX, REPORT_START, VOLUNTEERS, Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORES = ScoreRules(
    scores=(("Strong yes", 1), ("Lean yes", 2), ("Undecided", 3), ("Lean no", 4), ("Strong no", 5)),
    ignored="Not Voting",
)
SURVEY_DEFS = [("purchase", "ID"), ("signup", "Plan"), ("click", "Vol Ask"), ("error", "Detailed Plan")]
CODES = SupportCodes(questions=("error",), support=("r0",), undecided=("r1",), against=("r2",))
RESPONSE_NAMES = [(question, f"r{n}", f"{question} answer {n}") for question in ("error", "signup") for n in range(5)]
PARAMS = Params(
    as_of=AS_OF,
    calendar_start=CALENDAR_START,
    report_start=REPORT_START,
    scores=SCORES,
    codes=CODES,
    questions=GrowthQuestions(support="purchase", plan="signup"),
    question_labels={"purchase": "(1) Support ID", "signup": "(2) Vote Plan", "click": "(3) Vol Ask"},
    tag_ids={"t0": "early_voted", "t1": "ballot_received", "t2": "ballot_mailed", "t3": "request_received"},
    groups={"member": "group-members", "out_of_state": "group-out-of-state", "everyone_else": "group-others"},
    voter_feed=feeds.VoterFeedParams("error", "signup", "click", "purchase"),
    home_state=HOME_STATE,
    uncontactable_tag="t4",
    note_category="User ID",
    prefix=PREFIX,
    tag_names={"t0": "Voted early", "t1": "Ballot is in", "t2": "Ballot is out", "t3": "Asked for a ballot"},
    tag_order=("tag_timestamp", "event_id"),
)
# input tables whose role has another name
ROLE_OF = {
    "training_tracker": "training",
    "leader_codes": "leaders",
    "external_responses": "external",
    "person_records": "records",
    "phone_numbers": "phones",
    "election_voted": "election",
    "response_list": "responses",
}
LITERALS = {"survey_defs": SURVEY_DEFS, "support_names": RESPONSE_NAMES, "plan_names": RESPONSE_NAMES}
RMM, POD, PROGRAM = ops.LEVELS[1], ops.LEVELS[2], ops.LEVELS[3]


class Data(Reports):
    """The reports over the roles of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.roles = spark, root, Tables(spark, root)
        super().__init__(self.role, PARAMS)

    def role(self, name: str) -> DataFrame:
        if name in LITERALS:
            return self.spark.createDataFrame(LITERALS[name], TABLES[name])
        return getattr(self.roles, ROLE_OF.get(name, name))

    def __getattr__(self, name: str) -> DataFrame:
        # only reached for names that are no report: a given table or a role
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    @view
    def flat(self) -> DataFrame:
        return self.spark.sql(FLAT, relationships=self.table("relationships"), members=self.members)

    @view
    def typed_flat(self) -> DataFrame:
        return self.flat.withColumns(
            {
                "support_id_numeric": fn.to_int(F.col("support_id_numeric")),
                "cm_days": fn.days_between(F.lit(AS_OF), F.col("date_joined")),
            }
        )

    @view
    def volunteers(self) -> DataFrame:
        return self.spark.sql(VOLUNTEERS, relationships=self.table("relationships"), users=self.table("users"))

    @view
    def parsed(self) -> DataFrame:
        """The flat rows nested, written as JSON lines, read and flattened again."""
        self.store("flat")
        path = self.scratch("json")
        files.write_lines(nested.org_lines(nested.nest_networks(self.flat)), path)
        return nested.flatten_org(files.read_org(self.spark, path), AS_OF)

    @view
    def parsed_volunteers(self) -> DataFrame:
        """The volunteers' rows nested, written as JSON lines, read and flattened again."""
        self.store("volunteers")
        path = self.scratch("volunteers-json")
        files.write_lines(nested.org_lines(nested.nest_volunteers(self.volunteers)), path)
        return nested.flatten_volunteers(files.read_volunteers(self.spark, path))

    def scratch(self, label: str) -> str:
        return sinks.scratch(self.spark, label)


def query(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
    QUERIES[build.__name__] = lambda spark, root: build(Data(spark, root))
    return build


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that engines summing in another order agree."""
    return df.withColumns({c: F.round(c, 6) for c, kind in df.dtypes if kind == "double"})


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- scans, sources, sinks -------------------------------------------------------------


@query
def scan_project(d: Data) -> DataFrame:
    return d.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")).select(
        "o_orderkey", F.col("o_custkey").alias("user_id"), "o_totalprice", F.to_date("o_orderdate").alias("day")
    )


@query
def csv_roundtrip(d: Data) -> DataFrame:
    path = d.scratch("csv")
    df = d.users.select("user_id", "first_name", "last_name", "state", "date_joined")
    files.write_csv(df, path)
    return files.read_csv(d.spark, path, df.schema)


@query
def json_flatten(d: Data) -> DataFrame:
    return d.parsed


@query
def json_pretty(d: Data) -> DataFrame:
    """The flat rows as one pretty-printed object in one file, read back by many tasks."""
    d.store("flat")
    path = d.scratch("pretty")
    pretty.write_pretty_org(nested.nest_networks(d.flat), path)
    return nested.flatten_org(pretty.read_pretty_org(d.spark, path), AS_OF)


@query
def json_nest(d: Data) -> DataFrame:
    d.store("flat")
    docs = nested.org_lines(nested.nest_networks(d.flat)).select(F.from_json("value", ORG).alias("doc"))
    cms = docs.select(F.explode("doc").alias("pod", "leaders")).select("pod", F.explode("leaders").alias("leader"))
    networks_of = cms.select("pod", "leader.rmm", F.explode("leader.cms").alias("cm"))
    fits = (F.size("cm.network") <= 1000).alias("fits")
    people = networks_of.select("pod", "rmm", "cm.user_id", fits, F.explode("cm.network").alias("person"))
    return people.select("pod", "rmm", "user_id", "fits", "person.voter", "person.sos_id", "person.tier")


@query
def id_label_last(d: Data) -> DataFrame:
    return sync.last_labels(
        d.tag_history, "state_file_id", "tag_name", [F.col("tag_date").desc(), F.col("event_id").desc()]
    )


@query
def match_members(d: Data) -> DataFrame:
    return d.members


@query
def report_sink(d: Data) -> DataFrame:
    report = d.relationships.groupBy("relationship_type", "relationship_status").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users")
    )
    path = sinks.write_report(report, d.scratch("reports"), "relationships")
    return d.spark.read.schema(report.schema).parquet(path)


@query
def self_replace(d: Data) -> DataFrame:
    root = d.scratch("users")
    users = d.users.select("user_id", "state", "date_joined")
    sinks.replace_version(d.spark, users, root)
    again = sinks.read_version(d.spark, root, users.schema).fillna("unknown", ["state"])
    sinks.replace_version(d.spark, again, root)
    # another session finds the table by its folder alone
    return sinks.read_version(d.spark.newSession(), root, users.schema)


@query
def table_as_select(d: Data) -> DataFrame:
    path = d.scratch("table")
    name = "saved_" + path.rpartition("-")[2]
    sinks.save_table(d.users.select("user_id", "state"), name, path)
    sinks.save_table(d.users.where("state IS NOT NULL").select("user_id", "state"), name, path)
    return d.spark.table(name)


@query
def sheet_labels(d: Data) -> DataFrame:
    path = d.scratch("labels")
    files.write_csv(d.tag_history.select(F.col("state_file_id").alias("id"), F.col("tag_name").alias("label")), path)
    return files.read_id_labels(d.spark, path).groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def sheet_members(d: Data) -> DataFrame:
    path = d.scratch("sheet")
    sheet = d.training.select(*TABLES["training_tracker"].names)
    files.write_csv(sheet, path)
    read = files.read_sheet(d.spark, path, "training_sheet", TABLES["training_tracker"])
    return members.match_members(read, d.leaders, d.users)


@query
def append_log(d: Data) -> DataFrame:
    root = d.scratch("log")
    known = F.col("voting_status") == "other"
    sinks.append_log(d.tag_log.where(~known), root)
    sinks.append_log(d.tag_log.where(~known), root)
    sinks.compact_log(d.spark, root, d.tag_log.schema, sync.STATUS_KEYS)
    sinks.append_log(d.tag_log.where(known), root)
    return sinks.read_version(d.spark, root, d.tag_log.schema)


@query
def sync_success(d: Data) -> DataFrame:
    path = d.scratch("results")
    outcome = F.when(F.col("alloy_sos_id").endswith("7"), "error").otherwise("success")
    person = F.struct(F.col("alloy_sos_id").alias("person_id"), outcome.alias("status"))
    sent = ops.bounded_batches(d.tag_log, "voting_status", "alloy_sos_id")
    responses = sent.groupBy(F.col("voting_status").alias("tag"), "batch_no").agg(
        F.collect_list(person).alias("people")
    )
    files.write_json(responses.drop("batch_no"), path)
    return sync.successes(files.read_results(d.spark, path))


@query
def sync_loop(d: Data) -> DataFrame:
    """Delta, payloads, responses and log; then what the next run has to send again."""
    d.store("delta")
    root, path = d.scratch("log"), d.scratch("responses")
    sinks.append_log(d.tag_log, root)
    people = "people array<struct<person_id:string>>"
    payloads = d.tag_payloads().withColumn("people", F.from_json("payload_json", people)["people"])
    outcome = lambda p: F.when(p["person_id"].endswith("7"), "error").otherwise("success")
    answered = F.transform("people", lambda p: F.struct(p["person_id"].alias("person_id"), outcome(p).alias("status")))
    files.write_json(payloads.select(F.col("voting_status").alias("tag"), answered.alias("people")), path)
    sinks.append_log(sync.successes(files.read_results(d.spark, path)), root)
    log = sinks.read_version(d.spark, root, d.tag_log.schema)
    return sync.status_delta(
        d.absentee, d.voter_file, d.tag_history, log, PARAMS.tag_ids, d.tag_order(), PREFIX
    )


@query
def events_of_days(d: Data) -> DataFrame:
    """Events written in a folder per day; three days of them read back."""
    events = d.events.select("event_id", "user_id", "event_type", "value", "ts", F.to_date("ts").alias("day"))
    path = d.scratch("events-by-day")
    layout.write_by_day(events, path, "day")
    some = layout.read_by_day(d.spark, path, events.schema, dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    return rounded(some.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


@query
def events_refreshed(d: Data) -> DataFrame:
    """All days but the last written first; then the table is brought up to date, which writes one folder."""
    events = d.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    path, last = d.scratch("events-refreshed"), events.agg(F.max("day")).first()[0]
    layout.write_by_day(events.where(F.col("day") < F.lit(last)), path, "day")
    layout.refresh_days(events, path, "day", "ts")
    table = layout.read_by_day(d.spark, path, events.schema)
    return table.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_events"), F.sum("user_id").alias("users"))


@query
def bucketed_network(d: Data) -> DataFrame:
    """Relationships and vote days in buckets of the person; per user, people and those with a vote day."""
    names = [f"edges_{uuid.uuid4().hex}", f"votes_{uuid.uuid4().hex}"]
    edges = d.relationships.where("reach_id IS NOT NULL").select("user_id", "reach_id").distinct()
    voted = d.votes.select("reach_id").distinct().withColumn("voted", F.lit(True))
    for df, name in ((edges, names[0]), (voted, names[1])):
        layout.write_buckets(df, name, "reach_id", 8, d.scratch(name))
    both = ops.split_join(d.spark.table(names[0]), d.spark.table(names[1]), "reach_id", "left", hot=False)
    return both.groupBy("user_id").agg(F.count("reach_id").alias("people"), F.count("voted").alias("voted"))


@query
def outbox_retry(d: Data) -> DataFrame:
    """Half of the responses are lost once; how often a receiver that knows payload ids applied each status."""
    d.store("delta")
    box, root = d.scratch("outbox"), d.scratch("log")
    targets = {status: (tag, PARAMS.tag_names[tag]) for tag, status in PARAMS.tag_ids.items()}
    empty = d.spark.createDataFrame([], outbox.OUTBOX_SCHEMA)
    for rows, path in ((empty, box), (d.tag_log, root)):
        sinks.append_log(rows, path)
    received = []
    for attempt in range(2):
        log = sinks.read_version(d.spark, root, d.tag_log.schema)
        waiting = sinks.read_version(d.spark, box, empty.schema)
        current = ops.anti(d.delta, log, sync.STATUS_KEYS)
        sinks.append_log(sinks.stored(outbox.enqueue(current, waiting, "State File ID", targets=targets), "new-payloads"), box)
        waiting = sinks.read_version(d.spark, box, empty.schema)
        sent = sinks.stored(outbox.unconfirmed(waiting), "sent")
        received.append(sent)
        person = lambda p: F.struct(p["person_id"].alias("person_id"), F.lit("success").alias("status"))
        people = F.transform(F.from_json("payload_json", outbox.PEOPLE)["people"], person)
        lost = F.substring("payload_id", 1, 1).isin(*"01234567") if attempt == 0 else F.lit(False)
        responses = sinks.stored(sent.where(~lost).select("payload_id", people.alias("people")), "responses")
        done, closed = outbox.confirm(waiting, responses)
        sinks.append_log(sinks.stored(done, "done"), root)
        sinks.append_log(sinks.stored(closed, "closed"), box)
    applied = union(received).dropDuplicates(["payload_id"])
    person = F.explode(F.from_json("payload_json", outbox.PEOPLE)["people"]).alias("p")
    each = applied.select("voting_status", person).groupBy(F.col("p.person_id").alias("alloy_sos_id"), "voting_status")
    return each.agg(F.count(F.lit(1)).alias("applied"))


@query
def growth_program(d: Data) -> DataFrame:
    return (
        growth.with_program(d.members)
        .groupBy("program", F.col("date_joined").alias("day"))
        .agg(F.countDistinct("user_id").alias("n_new_users"))
    )


@query
def delta_routed(d: Data) -> DataFrame:
    path = d.scratch("routed")
    sinks.route(d.delta, "voting_status", path)
    return d.spark.read.schema(d.delta.schema).parquet(path)


@query
def batch_payload(d: Data) -> DataFrame:
    targets = {status: (tag, PARAMS.tag_names[tag]) for tag, status in PARAMS.tag_ids.items()}
    current = sinks.stored(sync.current_statuses(d.absentee, d.voter_file, PREFIX), "statuses")
    batches = sync.tag_payloads(current, "voting_status", "alloy_sos_id", "State File ID", targets=targets)
    doc = "name string, locked boolean, people array<struct<person_id:string,person_id_type:string,action:string>>"
    return batches.select("tag_id", "batch_size", F.from_json("payload_json", doc).alias("p")).select(
        "tag_id", "p.name", F.explode("p.people").alias("person"), (F.col("batch_size") <= 1000).alias("fits")
    ).select("tag_id", "name", "person.person_id", "person.person_id_type", "person.action", "fits")


@query
def group_payload(d: Data) -> DataFrame:
    d.store("segments")
    users = F.from_json("payload_json", "users array<struct<user_id:bigint>>")["users"]
    return (
        sync.group_payloads(d.segments)
        .select("group_id", F.explode(users).alias("user"), (F.col("batch_size") <= 1000).alias("fits"))
        .select("group_id", "user.user_id", "fits")
    )


# --- activity ----------------------------------------------------------------------------


@query
def last_activity(d: Data) -> DataFrame:
    return d.activity


@query
def joined_before_today(d: Data) -> DataFrame:
    return d.users.select("user_id", (F.col("date_joined") < fn.today_in("America/New_York")).alias("is_past"))


@query
def people_union(d: Data) -> DataFrame:
    return d.people


@query
def activity_feed(d: Data) -> DataFrame:
    d.prepare("activity_feed")
    return d.activity_feed().select(
        "user_id",
        "user_name",
        "rmm",
        "pod",
        F.to_date("action_timestamp").alias("action_day"),
        F.hour("action_timestamp").alias("action_hour"),
        "action",
        "value",
        "voter",
        "sos_id",
    )


# --- members -----------------------------------------------------------------------------


@query
def match_errors(d: Data) -> DataFrame:
    return d.match_errors()


@query
def sheet_order(d: Data) -> DataFrame:
    """Matching errors of a sheet in four files that holds no row numbers."""
    path = d.scratch("sheet")
    sheet = d.training.repartitionByRange(4, "row_no").sortWithinPartitions("row_no").drop("row_no")
    files.write_csv(sheet, path)
    return members.match_errors(sheets.read_numbered(d.spark, path, sheet.schema), d.leaders, d.users, "row_no")


@query
def clean_phone(d: Data) -> DataFrame:
    return d.training.select(
        "row_no", F.col("phone_number").alias("phone_raw"), fn.clean_phone(F.col("phone_number")).alias("phone_clean")
    )


@query
def full_name(d: Data) -> DataFrame:
    return d.users.select("user_id", fn.full_name(F.col("first_name"), F.col("last_name")).alias("user_name"))


# --- answers, status, tiers ----------------------------------------------------------------


@query
def latest_answers(d: Data) -> DataFrame:
    return d.answers.drop("canvass_timestamp")


@query
def score_multiselect(d: Data) -> DataFrame:
    return answers.score_answers(answers.latest_raw_answers(d.responses, d.survey_defs), SCORES)


@query
def pivot_answers(d: Data) -> DataFrame:
    return d.wide


@query
def first_answer(d: Data) -> DataFrame:
    return ops.first_answer(
        d.responses, "question_name", "reach_id", "canvass_timestamp", "response_id", "canvass_date"
    )


@query
def array_index(d: Data) -> DataFrame:
    picked = fn.choices(F.col("response_value"))
    return d.responses.select(
        "user_id", "reach_id", "response_id", F.size(picked).alias("n_choices"), F.get(picked, 0).alias("first_choice")
    ).where("n_choices IS NOT NULL")


@query
def vote_status(d: Data) -> DataFrame:
    return d.status


@query
def voted_sets(d: Data) -> DataFrame:
    return status.voted_sets(d.absentee, d.voter_file)


@query
def support_merge(d: Data) -> DataFrame:
    merged = tiers.support_merge(d.external, d.answers, d.crosswalk, d.voter_file, CODES)
    return merged.select("person_id", "value", F.to_date("datetime_canvassed").alias("day"))


@query
def voter_tiers(d: Data) -> DataFrame:
    return d.tiers


@query
def support_full(d: Data) -> DataFrame:
    return d.support


@query
def network_scores(d: Data) -> DataFrame:
    return d.network_scores()


@query
def answer_names(d: Data) -> DataFrame:
    return feeds.named_answers(
        d.external,
        d.support_names,
        "master_survey_question_id",
        "master_survey_response_id",
        "msq_currency",
        "error",
        "support_id",
    )


# --- growth and topline ----------------------------------------------------------------------


@query
def growth_first_touch(d: Data) -> DataFrame:
    edges = d.relationships.where("relationship_status = 'Active'").join(d.members.select("user_id", *RMM.keys), "user_id")
    first = ops.first_touch(edges, "reach_id", list(RMM.keys), "relationship_created_timestamp")
    counts = {
        "n_new_voters": None,
        "n_new_matched_voters": F.col("auto_applied_tag") == "Voter",
        "n_new_reach_adds": F.col("auto_applied_tag") == "Reach Add",
    }
    return ops.distinct_counts(
        first.withColumnRenamed("relationship_created_date", "day"), ["rmm", "pod", "day"], "reach_id", counts
    )


@query
def vote_days(d: Data) -> DataFrame:
    touched = growth.group_touches(d.members, growth.touches(d.relationships), RMM)
    day = fn.greatest_strict(F.col("first_day"), F.col("date_voted"))
    return touched.join(d.votes, "reach_id").select("rmm", "pod", "reach_id", day.alias("day")).distinct()


@query
def growth_dense(d: Data) -> DataFrame:
    return rounded(d.growth(RMM, "dense"))


@query
def growth_sparse(d: Data) -> DataFrame:
    d.prepare("growth_cm")
    return rounded(d.growth(ops.LEVELS[0]))


@query
def growth_rates(d: Data) -> DataFrame:
    return rounded(d.growth(PROGRAM).select("program", "day", *growth.RATES))


@query
def growth_today(d: Data) -> DataFrame:
    return rounded(d.growth(POD).select("pod", "day", "todays_voters_per_cm_week", "todays_pct_votes"))


@query
def support_histogram(d: Data) -> DataFrame:
    people = topline.group_people(d.relationships, d.members, RMM).join(d.wide, "reach_id")
    return rounded(topline.support_histogram(people, list(RMM.keys)))


@query
def nonvoting_rates(d: Data) -> DataFrame:
    people = topline.group_people(d.relationships, d.members, RMM).join(d.profile, "reach_id")
    return rounded(topline.nonvoting_rates(people, list(RMM.keys)))


@query
def topline_levels(d: Data) -> DataFrame:
    d.prepare(*[f"topline_{level.name}" for level in ops.LEVELS[1:]])
    tops = ops.per_level(d.topline, ops.LEVELS[1:])
    keyed = [
        df.select(
            F.lit(level.name).alias("level"),
            F.concat_ws("|", *level.keys).alias("group_key"),
            *[c for c in df.columns if c not in level.keys],
        )
        for level, df in zip(ops.LEVELS[1:], tops.values())
    ]
    return rounded(union(keyed))


@query
def member_enriched(d: Data) -> DataFrame:
    d.prepare("topline_cm")
    return rounded(d.member_topline())


@query
def rollup_levels(d: Data) -> DataFrame:
    def counts(level: ops.Level) -> DataFrame:
        people = topline.group_people(d.relationships, d.members, level)
        return people.groupBy(F.concat_ws("|", *level.keys).alias("group_key")).agg(
            F.lit(level.name).alias("level"), F.count("reach_id").alias("voters")
        )

    return union(list(ops.per_level(counts).values()))


@query
def topline_summary(d: Data) -> DataFrame:
    levels = (ops.Level("cm", ("user_id", "rmm", "pod")), *ops.LEVELS[1:])
    counts = topline.summary_counts(growth.with_program(d.parsed), ["rmm", "pod", "program"])
    counts = sinks.stored(counts, "summary-counts")
    tops = [
        topline.summarise(counts, list(level.keys)).select(
            F.lit(level.name).alias("level"), F.concat_ws("|", *level.keys).alias("group_key"), "*"
        ).drop(*level.keys)
        for level in levels
    ]
    return rounded(union(tops))


@query
def member_summary(d: Data) -> DataFrame:
    return rounded(topline.member_summary(d.typed_flat))


@query
def member_list(d: Data) -> DataFrame:
    return nested.member_list(d.typed_flat)


@query
def distinct_then_sum(d: Data) -> DataFrame:
    days = fn.days_between(F.lit(AS_OF), F.col("date_joined"))
    rows = d.relationships.select("user_id").distinct().join(d.members, "user_id").withColumn("days", days)
    return ops.sum_once(rows, ["rmm", "pod"], ["user_id"], "days", "cm_days")


# --- counts ----------------------------------------------------------------------------------


@query
def network_counts(d: Data) -> DataFrame:
    counts = ops.distinct_counts(
        d.relationships,
        ["user_id"],
        "reach_id",
        {
            "voters": None,
            "matched_voters": F.col("state_file_id").isNotNull(),
            "reach_adds": F.col("state_file_id").isNull(),
        },
    )
    return d.users.select("user_id").join(counts, "user_id", "left").fillna(0, counts.columns[1:])


@query
def null_audit(d: Data) -> DataFrame:
    return ops.frequency(d.relationships, F.col("state_file_id").isNull(), "is_missing")


@query
def latest_tag(d: Data) -> DataFrame:
    return sync.latest_tags(d.tag_history, d.tag_order()).select(
        "reach_id", "tag_id", "event_id", "state_file_id", "tag_action", "tag_date"
    )


# --- queues, lists, feeds ----------------------------------------------------------------------


@query
def work_queue(d: Data) -> DataFrame:
    d.prepare("work_queue")
    return d.work_queue()


@query
def non_member_users(d: Data) -> DataFrame:
    return d.volunteer_users()


@query
def non_member_people(d: Data) -> DataFrame:
    return d.volunteer_people()


@query
def id_crosswalk(d: Data) -> DataFrame:
    return d.id_crosswalk


@query
def not_enrolled(d: Data) -> DataFrame:
    return d.not_enrolled()


@query
def not_in_list(d: Data) -> DataFrame:
    """NOT IN against a list without nulls, one with nulls and an empty one, null keys included."""
    users = d.users.select("user_id", "added_by_user_id")
    found = d.notes.select(F.col("note_text").alias("added_by_user_id"))
    lists_ = {"no_null": found.dropna(), "nulls": found, "empty": found.where("false")}
    return union(
        [
            ops.anti(users, listed, "added_by_user_id", null_aware=True).withColumn("list", F.lit(name))
            for name, listed in lists_.items()
        ]
    )


@query
def user_segments(d: Data) -> DataFrame:
    return d.segments


@query
def uncontactable(d: Data) -> DataFrame:
    return d.uncontactable()


@query
def strip_prefix(d: Data) -> DataFrame:
    return d.feed_relationships()


@query
def email_users(d: Data) -> DataFrame:
    return d.feed_users()


@query
def household_expand(d: Data) -> DataFrame:
    return feeds.expanded_network(d.relationships, d.voter_file, PREFIX)


@query
def mark_flag(d: Data) -> DataFrame:
    past = d.election.where("election_id = 'purchase'").select(
        F.col("registration_id").alias("master_registration_id")
    )
    marked = ops.mark_join(d.voter_file, past, "master_registration_id", "voted_general", three_valued=True)
    return marked.select("sos_id", "voted_general")


@query
def email_voters(d: Data) -> DataFrame:
    return d.feed_voters()


@query
def delta_sync(d: Data) -> DataFrame:
    return d.delta


# --- nested summaries, templates, sampling --------------------------------------------------------


@query
def volunteer_summary(d: Data) -> DataFrame:
    return nested.volunteer_summary(d.parsed_volunteers)


@query
def volunteer_list(d: Data) -> DataFrame:
    return nested.volunteer_list(d.parsed_volunteers)


def order_series(d: Data) -> DataFrame:
    return d.orders.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(
        F.countDistinct("o_custkey").alias("users"),
        F.count(F.lit(1)).alias("matched_voters"),
        F.count_if(F.col("o_orderstatus") == "P").alias("reach_adds"),
        F.max("o_totalprice").alias("voters_per_cm_week"),
        F.count_if(F.col("o_orderstatus") == "F").alias("votes"),
    )


def order_template(d: Data) -> DataFrame:
    return templates.fit_template(order_series(d), "o_orderpriority", TEMPLATE_END)


TEMPLATE_END = AS_OF.replace(year=2000, month=6, day=30)


@query
def template_fit(d: Data) -> DataFrame:
    return rounded(order_template(d))


def relationship_totals(d: Data, keys: list[str]) -> DataFrame:
    """Totals per group; users and people are counted from their distinct pairs with the group.

    The parts are put side by side by grouping, not by joins: a group may be all there is.
    """
    rows = d.relationships.withColumn("program", F.lit("CM"))
    sums = rows.groupBy(*keys).agg(
        F.count_if(F.col("auto_applied_tag") == "Voter").alias("matched_voters"),
        F.count_if(F.col("auto_applied_tag") == "Reach Add").alias("reach_adds"),
    )
    users = ops.distinct_counts(rows, keys, "user_id", {"users": None})
    people = ops.distinct_counts(rows, keys, "reach_id", {"votes": None})
    parts = sums.unionByName(users, allowMissingColumns=True).unionByName(people, allowMissingColumns=True)
    counts = [F.max(c).alias(c) for c in ("users", "matched_voters", "reach_adds", "votes")]
    return parts.groupBy(*keys).agg(*counts, F.lit(7.0).alias("voters_per_cm_week"))


@query
def template_scale(d: Data) -> DataFrame:
    keys = ["relationship_type", "relationship_status"]
    return rounded(templates.scale_template(relationship_totals(d, keys), order_template(d), keys, seed=7))


@query
def template_levels(d: Data) -> DataFrame:
    """Growth from templates at three levels of grouping."""
    template = sinks.stored(order_template(d), "template")
    levels = {
        "leader": ["relationship_type", "relationship_status"],
        "pod": ["relationship_type"],
        "program": ["program"],
    }
    scaled = []
    for level, keys in levels.items():
        rows = templates.scale_template(relationship_totals(d, keys), template, keys, seed=7)
        key = F.concat_ws("|", *keys).alias("group_key")
        scaled.append(rows.select(F.lit(level).alias("level"), key, *[c for c in rows.columns if c not in keys]))
    return rounded(union(scaled))


@query
def topline_template(d: Data) -> DataFrame:
    counts = ops.distinct_counts(
        d.relationships,
        ["user_id"],
        "reach_id",
        {"matched_voters": F.col("state_file_id").isNotNull(), "reach_adds": F.col("state_file_id").isNull()},
    )
    return templates.topline_template(counts, d.users)


@query
def bootstrap_assign(d: Data) -> DataFrame:
    dist = d.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return ops.bootstrap_assign(d.users.select("user_id"), "user_id", dist, "o_orderkey", seed=11)


@query
def weighted_assign(d: Data) -> DataFrame:
    weights = {"Has Voted!": 40, "Needs to Return Ballot": 15, "Needs to Vote": 25, "none": 20}
    return ops.weighted_assign(d.users.select("user_id"), "user_id", weights, "drawn", seed=3)


# --- streaming --------------------------------------------------------------------------------------


def in_files(d: Data, name: str, n: int = 4) -> str:
    """A given table in several files, so that a stream over it takes several epochs."""
    path = d.scratch(name)
    getattr(d.roles, name).repartition(n).write.parquet(path)
    return path


@query
def stream_delta_sync(d: Data) -> DataFrame:
    log_path, checkpoint = d.scratch("stream-log"), d.scratch("stream-checkpoint")
    source = tables.stream(d.spark, in_files(d, "part"), BASE["part"], files_per_epoch=1)

    def statuses(batch: DataFrame) -> DataFrame:
        # the status role of the parts in this micro-batch
        dated = {
            "date_early_voted": F.col("p_partkey") % 7 == 0,
            "date_ballot_received": F.col("p_partkey") % 8 == 0,
            "date_ballot_mailed": F.col("p_partkey") % 4 == 0,
            "date_request_received": F.col("p_partkey") % 2 == 0,
        }
        known = F.col("p_partkey") % 3 != 0
        rows = batch.select(
            F.when(known, F.col("p_partkey") + 2000000).alias("myv_van_id"),
            *[F.when(dated[day], F.lit(AS_OF)).alias(day) for day, _, _ in STATUS_STEPS],
        )
        return sync.current_statuses(rows, d.voter_file, PREFIX)

    present = sync.present_statuses(d.tag_history, d.tag_log, PARAMS.tag_ids, d.tag_order())
    stream_delta(source, statuses, present, log_path, checkpoint).awaitTermination()
    return read_log(d.spark, log_path).select(*sync.STATUS_KEYS)


QUERIES["stream_delta"] = QUERIES.pop("stream_delta_sync")


@query
def stream_latest_event(d: Data) -> DataFrame:
    sink, checkpoint = d.scratch("latest"), d.scratch("latest-checkpoint")
    source = tables.stream(d.spark, in_files(d, "events"), BASE["events"], files_per_epoch=1)
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    rows = source.select(*keys, *order, "value")
    stream_latest(rows, keys, order, sink, checkpoint, fold_every=3).awaitTermination()
    return read_latest(d.spark, sink, rows.schema, keys).select(*keys, "event_id", "value")


QUERIES["stream_latest"] = QUERIES.pop("stream_latest_event")
