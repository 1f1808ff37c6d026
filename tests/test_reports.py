import datetime as dt
import itertools
import random
import re

import pytest
from frames import SF, plan_of, sets
from pyspark.sql import functions as F

from rapport import operators as ops
from rapport.labels import GrowthQuestions, ScoreRules, SupportCodes, TierRules
from rapport.plans import activity, answers, growth, lists, members, networks, queues, status, tiers, topline
from workloads.queries import Data

D = dt.date


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


# --- members -------------------------------------------------------------------------------


@pytest.fixture
def sheet(frame):
    kinds = dict(invite_code="string", phone_number="string", cm_name="string", email_address="string", row_no="int")
    rows = [
        ("N1", None, "null phone"),
        ("N1", "555-01", "short phone"),
        ("NX", "404 555 0001", "unknown code"),
        ("N1", "404 555 0009", "unmatched"),
        ("N1", "404 555 0002", "twice, first"),
        (" N1 ", "(404)5550002", "twice, second"),
        (" N2", "404 555 0003", "fine, two users"),
        (None, "404 555 0003", "no code"),
    ]
    data = [dict(invite_code=c, phone_number=p, cm_name=n, row_no=i) for i, (c, p, n) in enumerate(rows)]
    return frame(None, data, **kinds)


@pytest.fixture
def leaders(frame):
    return frame("leader_codes", [dict(invite_code="N1", rmm="r1", pod="p1"), dict(invite_code="N2", rmm="r2", pod="p1")])


@pytest.fixture
def phone_users(frame):
    users = [("u1", "4045550001"), ("u2", "4045550002"), ("u3", "4045550003"), ("u4", "4045550003"), ("u5", None)]
    return frame("users", [dict(user_id=u, phone_number=p, first_name="F", invite_code="other") for u, p in users])


def test_members_match_by_code_and_phone(sheet, leaders, phone_users):
    out = members.match_members(sheet, leaders, phone_users)
    expected = [("u2", "F", "r1"), ("u3", "F", "r2"), ("u4", "F", "r2")]
    assert sets(out, "user_id", "user_name", "rmm") == expected


def test_match_errors_give_the_first_reason(sheet, leaders, phone_users):
    found = members.match_errors(sheet, leaders, phone_users, "row_no").collect()
    out = sorted(found, key=lambda r: -r.row_no)
    assert [(r.cm_name, r.matching_error) for r in out] == [
        ("twice, second", members.SHARED_PHONE),
        ("twice, first", members.SHARED_PHONE),
        ("unmatched", members.NO_USER),
        ("unknown code", members.BAD_CODE),
        ("short phone", members.BAD_PHONE),
        ("null phone", members.BAD_PHONE),
    ]


# --- status, answers, tiers ------------------------------------------------------------------


@pytest.fixture
def file(frame):
    rows = [dict(sos_id=f"s{i}", person_id=f"p{i}", myv_van_id=f"v{i}", reg_on_current_file=i != 9) for i in range(1, 10)]
    return frame("voter_file", rows)


@pytest.fixture
def cross(frame):
    rows = [dict(reach_id=f"r{i}", sos_id=f"s{i}") for i in range(1, 10)]
    return frame("crosswalk", [*rows, dict(reach_id="r1", sos_id="s2"), dict(reach_id="r99", sos_id=None)])


@pytest.fixture
def absentee(frame):
    return frame(
        "absentee",
        [
            dict(myv_van_id="v1", date_early_voted=D(2024, 1, 5), date_request_received=D(2024, 1, 1)),
            dict(myv_van_id="v2", date_ballot_received=D(2024, 1, 6), date_ballot_mailed=D(2024, 1, 2)),
            dict(myv_van_id="v3", date_ballot_mailed=D(2024, 1, 2)),
            dict(myv_van_id="v4", date_request_received=D(2024, 1, 2)),
            dict(myv_van_id="v5"),
            dict(myv_van_id="v6", date_early_voted=D(2024, 1, 7)),
            dict(myv_van_id="v6"),
        ],
    )


def test_status_ladder(cross, file, absentee):
    out = status.vote_status(cross, file, absentee)
    rows = sets(out, "reach_id", "sos_id", "voting_status_raw", "voting_status", "voting_status_priority")
    assert rows == sorted(
        [
            ("r1", "s1", "Early Voted", "Has Voted!", 10),
            ("r1", "s2", "Ballot Received", "Has Voted!", 10),
            ("r2", "s2", "Ballot Received", "Has Voted!", 10),
            ("r3", "s3", "Ballot Mailed", "Needs to Return Ballot", 3),
            ("r4", "s4", "Request Received", "Needs to Vote", 1),
            ("r5", "s5", "Needs to Vote", "Needs to Vote", 1),
            ("r6", "s6", "Early Voted", "Has Voted!", 10),
            ("r6", "s6", "Needs to Vote", "Needs to Vote", 1),
            ("r7", "s7", "Needs to Vote", "Needs to Vote", 1),
            ("r8", "s8", "Needs to Vote", "Needs to Vote", 1),
        ],
        key=repr,
    )


def test_voted_sets_look_at_all_rows_of_a_person(absentee, file):
    out = {r.person_id: (r.voted, r.pending) for r in status.voted_sets(absentee, file).collect()}
    assert out["p6"] == (True, False) and out["p3"] == (False, True) and out["p5"] == (False, False)


def test_network_counts_a_person_with_one_open_row_as_not_voted(frame, cross, file, absentee, spark):
    edges = frame(
        "relationships",
        [dict(user_id="u", reach_id=r, relationship_status="Active") for r in ("r1", "r3", "r6", "r6", "r9")]
        + [dict(user_id="u", reach_id="r4", relationship_status="Inactive")],
    )
    scored = spark.createDataFrame([(f"p{i}", i % 4 + 1) for i in range(1, 9)], "person_id string, tier int")
    # r1 voted, r9 is not on the current file, r6 has one empty absentee row
    out = networks.network_scores(edges, cross, file, absentee, scored)
    assert sets(out) == [("u", 0, 0, 1, 1, 2)]


RULES = ScoreRules((("Strong yes", 1), ("Lean yes", 2), ("Undecided", 3), ("Strong no", 5)), "Not Voting")


def test_latest_answers_and_scores(frame, spark):
    defs = frame("survey_defs", [dict(question_id="q1", name_short="ID"), dict(question_id="q2", name_short="Vol Ask")])
    rows = [
        ("r1", "q1", '["Strong yes"]', 1),
        ("r1", "q1", '["Undecided","Strong yes"]', 3),
        ("r1", "q1", '["Lean yes","Strong no","Not Voting"]', 3),
        ("r2", "q1", '["Not Voting"]', 2),
        ("r3", "q1", "not json", 2),
        ("r4", "q1", None, 9),
        ("r4", "q1", "[]", 1),
        ("r5", "q2", '["Strong yes"]', 1),
        ("r6", "q1", '["Strong yes"]', 1),
        ("r7", "q9", "x", 1),
    ]
    responses = frame(
        "responses",
        [dict(reach_id=r, question_id=q, response_value=v, canvass_timestamp=ts(t)) for r, q, v, t in rows],
    )
    out = answers.latest_answers(responses, defs, RULES)
    assert sets(out, "reach_id", "response_value", "response_numeric") == [
        # of two answers at the latest moment the smaller text stays; (2 + 5) / 2 rounds up
        ("r1", "Lean yes\nStrong no\nNot Voting", 4),
        ("r2", "Not Voting", None),
        ("r3", None, None),
        ("r4", "", None),
        # another question with the same raw text carries the score too
        ("r5", '["Strong yes"]', 1),
        ("r6", "Strong yes", 1),
    ]
    wide = {r.reach_id: r for r in answers.wide_answers(out).collect()}
    assert (wide["r5"].vol_ask, wide["r5"].support_id, wide["r6"].support_id_numeric) == ('["Strong yes"]', None, 1)


CODES = SupportCodes(questions=("q",), support=("for",), undecided=("mid",), against=("con",))


def test_tier_rules_in_order(frame, file, spark):
    person = [f"p{i}" for i in range(1, 9)]
    support = [("p1", "con", 1), ("p2", "mid", 1), ("p3", "for", 1), ("p3", "con", 0), ("p8", "con", 2), ("p8", "for", 2)]
    external = frame(
        "external_responses",
        [
            dict(person_id=p, master_survey_question_id="q", master_survey_response_id=a, datetime_canvassed=ts(5 + t))
            for p, a, t in support
        ]
        + [dict(person_id="p4", master_survey_question_id="other", master_survey_response_id="con")],
    )
    scores = frame(
        "scores",
        [
            dict(person_id="p1", gotv_score=0.9),
            dict(person_id="p4", modeled_support_score=0.85),  # pending: tier 1
            dict(person_id="p5", modeled_support_score=0.85),  # not pending: tier 2
            dict(person_id="p6", modeled_support_score=0.9, gotv_score=0.0),  # gotv 0 wins over the model
            dict(person_id="p7", gotv_score=0.1),
        ],
    )
    absentee = frame(
        "absentee",
        [
            dict(myv_van_id="v4", date_request_received=D(2024, 1, 1)),
            dict(myv_van_id="v3", date_early_voted=D(2024, 1, 1)),
        ],
    )
    none = spark.createDataFrame([], "reach_id string, response_numeric bigint, canvass_timestamp timestamp")
    cross = frame("crosswalk", [])
    out = tiers.voter_tiers(file, absentee, scores, external, none, cross, TierRules(CODES))
    raw = {r.person_id: (r.tier, r.tier_raw, r.voted) for r in out.collect()}
    assert [raw[p] for p in person] == [
        (4, 4, False),
        (3, 3, False),
        (4, 1, True),
        (1, 1, False),
        (2, 2, False),
        (4, 4, False),
        (3, 3, False),
        (4, 4, False),
    ]


def test_empty_code_lists_match_nothing(frame, file, cross, spark):
    external = frame("external_responses", [dict(person_id="p1", master_survey_question_id="q")])
    none = spark.createDataFrame([], "reach_id string, response_numeric bigint, canvass_timestamp timestamp")
    assert tiers.support_merge(external, none, cross, file, SupportCodes()).count() == 0
    assert tiers.support_merge(external, none, cross, file, SupportCodes(questions=("q",))).first().value == -1


# --- activity ----------------------------------------------------------------------------------


def test_last_activity_may_lie_ahead(spark):
    days = spark.createDataFrame(
        [("a", D(2024, 1, 30)), ("b", D(2024, 1, 29)), ("c", D(2024, 2, 2)), ("d", D(2024, 1, 1)), ("a", D(2023, 1, 1))],
        "user_id string, day date",
    )
    out = activity.last_activity([days, days.limit(0)], D(2024, 1, 30))
    assert sets(out) == [("a", 0, "Today"), ("b", 1, "Yesterday"), ("c", -3, "-3 days ago"), ("d", 29, "29 days ago")]


def test_feed_keeps_both_spellings(frame, spark):
    member = spark.createDataFrame([("u", "U U")], "user_id string, user_name string")
    users = frame("users", [dict(user_id="u", date_joined=D(2024, 1, 1)), dict(user_id="x", date_joined=D(2024, 1, 1))])
    edges = frame(
        "relationships",
        [
            dict(user_id="u", reach_id="r1", relationship_type="Friend", relationship_status="Inactive",
                 relationship_created_timestamp=ts(2), person_first_name="Al", person_last_name="B"),
            dict(user_id="u", reach_id="r1", relationship_type="Friend", relationship_status=None,
                 relationship_created_timestamp=ts(3), person_first_name="al", person_last_name="B"),
        ],
    )
    responses = frame(
        "responses",
        [
            dict(user_id="u", reach_id="r2", question_name="q", response_id="1", response_value="yes", canvass_timestamp=ts(9)),
            dict(user_id="u", reach_id="r2", question_name="unlabelled", response_id="2", response_value="yes", canvass_timestamp=ts(9)),
            dict(user_id="u", reach_id="r2", question_name="q", response_id=None, response_value="yes", canvass_timestamp=ts(9)),
            dict(user_id="u", reach_id="r2", question_name="q", response_id="3", response_value=None, canvass_timestamp=ts(9)),
        ],
    )
    actions, tags = frame("contact_actions", []), frame("tag_history", [])
    file = frame("voter_file", [dict(sos_id="s2", first_name="jo-ann", last_name="o'neil")])
    cross = frame("crosswalk", [dict(reach_id="r2", sos_id="s2")])
    people = activity.people_union(cross, file, edges, actions)
    out = activity.activity_feed(member, users, actions, edges, responses, tags, people, {"q": "(1) Q"}).collect()
    out = sorted(out, key=lambda r: (-r.action_timestamp.timestamp(), r.user_id, r.voter))
    assert [(r.action, r.value, r.voter, r.sos_id) for r in out] == [
        ("Marked Survey Response", "(1) Q: yes", "Jo-Ann O'neil", "s2"),
        ("Added Relationship", "Friend", "Al B", "Reach Add"),
        ("Added Relationship", "Friend", "al B", "Reach Add"),
        ("Added Relationship", "Friend (Inactive)", "Al B", "Reach Add"),
        ("Added Relationship", "Friend (Inactive)", "al B", "Reach Add"),
        ("Joined Reach", None, "", None),
    ]


# --- growth: brute force over small random data with a hot person and a hot user ------------------

START, REPORT, AS_OF = D(2024, 1, 1), D(2024, 1, 6), D(2024, 1, 10)
QUESTIONS = GrowthQuestions("support", "plan")


@pytest.fixture(scope="module")
def world():
    rng = random.Random(4)
    users = [f"u{i}" for i in range(6)]
    people = [f"r{i}" for i in range(12)]
    rmm = {"u0": "a", "u1": "a", "u2": "b", "u3": "b", "u4": None, "u5": "c"}
    pod = {"a": "P", "b": "P", "c": "Q", None: "Q"}
    member = [
        dict(user_id=u, user_name=u.upper(), rmm=rmm[u], pod=pod[rmm[u]], email_address=u, phone_number="1",
             date_joined=D(2024, 1, rng.randint(1, 9)) if u != "u1" else D(2023, 12, 30))
        for u in users
    ]
    pairs = [(rng.choice(users), rng.choice(people)) for _ in range(40)]
    pairs += [("u0", p) for p in people] + [(u, "r0") for u in users] * 4
    edges = []
    for user, person in pairs:
        day, hour = rng.randint(1, 11), rng.randint(0, 2)
        edges.append(
            dict(user_id=user, reach_id=person, relationship_status=rng.choice(["Active", "Active", "Inactive", None]),
                 auto_applied_tag=rng.choice(["Voter", "Reach Add", None]), relationship_created_date=D(2024, 1, day),
                 relationship_created_timestamp=ts(day, hour))
        )
    responses = []
    for _ in range(60):
        day = rng.randint(1, 12)
        responses.append(
            dict(user_id="u", reach_id=rng.choice(people), question_name=rng.choice(["support", "plan", "other"]),
                 response_id=rng.choice([None, "x", "x"]), canvass_date=D(2024, 1, day), canvass_timestamp=ts(day))
        )
    votes = sorted({(rng.choice(people), D(2024, 1, rng.randint(1, 10))) for _ in range(8)})
    return member, edges, responses, votes


def brute_growth(world, keys):
    """Growth by direct counting: one set of people per group, measure and day."""
    member, edges, responses, votes = world
    member = [{**m, "program": "CM"} for m in member]
    key = lambda m: tuple(m[k] for k in keys)
    active = [(m, e) for e in edges for m in member if m["user_id"] == e["user_id"] and e["relationship_status"] == "Active"]
    stamp = "relationship_created_timestamp"
    first = {}
    for m, e in active:
        slot = (key(m), e["reach_id"])
        first[slot] = min(first.get(slot, e[stamp]), e[stamp])
    touched = {(key(m), e["reach_id"], e["relationship_created_date"], e["auto_applied_tag"])
               for m, e in active if e[stamp] == first[key(m), e["reach_id"]]}
    earliest = {}
    for r in responses:
        slot = (r["question_name"], r["reach_id"])
        earliest[slot] = min(earliest.get(slot, r["canvass_timestamp"]), r["canvass_timestamp"])
    answered = {(r["question_name"], r["reach_id"], r["canvass_date"]) for r in responses if r["response_id"]
                and r["canvass_timestamp"] == earliest[r["question_name"], r["reach_id"]]}
    in_group = {(key(m), e["reach_id"]) for m, e in active}
    events = {
        "users": {(key(m), m["user_id"], m["date_joined"]) for m in member},
        "voters": {(g, p, d) for g, p, d, _ in touched},
        "matched_voters": {(g, p, d) for g, p, d, t in touched if t == "Voter"},
        "reach_adds": {(g, p, d) for g, p, d, t in touched if t == "Reach Add"},
        "ids": {(g, p, d) for g, p in in_group for q, who, d in answered if q == "support" and who == p},
        "plans": {(g, p, d) for g, p in in_group for q, who, d in answered if q == "plan" and who == p},
        "votes": {(g, p, max(d, v)) for g, p, d, _ in touched for who, v in votes if who == p},
    }
    out = {}
    for group in {key(m) for m in member}:
        matches = None not in group  # an equality join never matches a null key
        member_days = None
        for offset in range((AS_OF - START).days + 1):
            day = START + dt.timedelta(offset)
            row = {}
            for name, found in events.items():
                n = sum(1 for g, _, d in found if g == group and START <= d <= day)
                row[name] = n if n and matches else None
            if row["users"]:
                member_days = (member_days or 0) + row["users"]
            if day >= REPORT:
                out[group, day] = (*row.values(), member_days)
    return out


def growth_rows(frame, world, level, form, partitions=4):
    member, edges, responses, votes = world
    kinds = dict.fromkeys(("user_id", "user_name", "rmm", "pod", "email_address", "phone_number"), "string")
    series = growth.growth_series(
        frame(None, member, **kinds, date_joined="date"),
        frame("relationships", edges).repartition(partitions),
        frame("responses", responses).repartition(partitions),
        frame(None, [dict(reach_id=p, date_voted=d) for p, d in votes], reach_id="string", date_voted="date"),
        level, QUESTIONS, START, REPORT, AS_OF, form,
    )
    return series


@pytest.mark.parametrize("form, level", list(itertools.product(["dense", "sparse"], ops.LEVELS)), ids=lambda p: getattr(p, "name", p))
def test_growth_equals_direct_counting(frame, world, form, level, shuffled_joins):
    rows = growth_rows(frame, world, level, form).collect()
    got = {(tuple(r[k] for k in level.keys), r.day): tuple(r[m] for m in (*growth.MEASURES, "cm_days")) for r in rows}
    assert len(rows) == len(got)
    assert got == brute_growth(world, level.keys)


@pytest.mark.parametrize("partitions", [1, 64])
def test_growth_does_not_depend_on_partitioning(frame, world, partitions):
    one = growth_rows(frame, world, ops.LEVELS[2], "sparse")
    assert sets(one) == sets(growth_rows(frame, world, ops.LEVELS[2], "sparse", partitions))


def test_rates_and_todays_values(frame, world):
    rows = growth_rows(frame, world, ops.LEVELS[3], "sparse").collect()
    last = max(rows, key=lambda r: r.day)
    assert last.voters_per_cm_week == pytest.approx(last.matched_voters / last.cm_days * 7)
    assert last.pct_matched_voters == pytest.approx((last.voters - (last.reach_adds or 0)) / last.voters)
    assert {r.todays_pct_votes for r in rows} == {last.pct_votes}


def test_sparse_growth_counts_in_one_shuffle_at_user_level(spark, frame, world, shuffled_joins):
    """Marks, joinings and report days meet in one aggregate, without a join of the days."""
    member = frame(None, world[0], user_id="string", date_joined="date")
    kinds = f"user_id string, reach_id string, first_day date, is_matched boolean, is_added boolean, marks {growth.MARKS}"
    people = spark.createDataFrame([("u", "r", START, True, False, [])], kinds)
    level = ops.LEVELS[0].narrow
    totals = growth.sparse_totals(member, growth.group_marks(member, people, level), level, START, REPORT, AS_OF)
    plan = plan_of(totals)
    assert "Join" not in plan
    assert len(re.findall(r"keys=\[user_id#\d+, day#\d+\], functions=\[partial_", plan)) == 1


def test_levels_above_users_do_not_reduce_pairs_first(spark, shuffled_joins):
    """Only a level of users, or a copy that others read, needs one row per user and person."""
    pairs = r"SortAggregate\(key=\[user_id#\d+L?, reach_id#\d+L?\]"
    data = Data(spark, SF)
    assert not re.findall(pairs, plan_of(data.people_at(ops.LEVELS[1])))
    assert re.findall(pairs, plan_of(data.people_at(ops.LEVELS[0])))


def test_user_columns_meet_the_last_day_only(spark):
    """A topline takes the last day of a user's series before the user's other columns are joined."""
    plan = plan_of(Data(spark, SF).topline(ops.LEVELS[0]))
    assert "row_number() windowspecdefinition(user_id" in plan
    assert not re.findall(r"row_number\(\) windowspecdefinition\(user_id#\d+L?, user_name", plan)


# --- topline and queues ---------------------------------------------------------------------------


@pytest.fixture
def small_topline(frame, spark):
    member = spark.createDataFrame(
        [("u1", "U1", "a", "P", "e", "1"), ("u2", "U2", "b", "P", "e", "2"), ("u3", "U3", "c", "Q", "e", "3")],
        "user_id string, user_name string, rmm string, pod string, email_address string, phone_number string",
    )
    pairs = [("u1", "r1"), ("u1", "r2"), ("u2", "r2"), ("u2", "r3"), ("u2", "r3"), ("u3", "r4")]
    edges = frame("relationships", [dict(user_id=u, reach_id=r, relationship_status="Active") for u, r in pairs])
    profile = spark.createDataFrame(
        [("r1", 1, "plan", True, 1, 0, 0, 0, 1), ("r2", 5, None, True, 0, 0, 0, 2, 2), ("r3", None, None, False, 0, 0, 1, 0, 1)],
        "reach_id string, support_id_numeric bigint, vote_plan string, nonvoting boolean, "
        "tier1 bigint, tier2 bigint, tier3 bigint, tier4 bigint, records bigint",
    )
    return member, edges, profile


def test_group_figures_match_the_separate_reports(small_topline):
    member, edges, profile = small_topline
    level = ops.LEVELS[1]
    people = topline.group_people(edges, member, level).join(profile, "reach_id", "left")
    keys = list(level.keys)
    figures = {r.rmm: r for r in topline.group_figures(people, keys).collect()}
    for report in (topline.support_histogram(people, keys), topline.nonvoting_rates(people, keys)):
        for row in report.collect():
            assert all(figures[row.rmm][c] == row[c] for c in report.columns)
    assert (figures["a"].tier1, figures["a"].tier4, figures["b"].tier3, figures["b"].tier4) == (1, 2, 0, 2)
    # nothing known about the only person of this group: no figures at all, not zeros
    assert {figures["c"][c] for c in figures["c"].asDict() if c not in keys} == {None}


def test_a_group_with_a_null_key_has_no_topline_figures(small_topline):
    member, edges, profile = small_topline
    member = member.withColumn("rmm", F.when(F.col("rmm") != "a", F.col("rmm")))
    series = member.select(*ops.LEVELS[0].keys, F.explode(F.array(F.lit(1), F.lit(2))).alias("day"))
    out = topline.topline(series, edges, member, profile, ops.LEVELS[0])
    assert sets(out, "user_id", "day", "support_id_fives", "num_nonvoting_voters", "tier4") == [
        ("u1", 2, None, None, None),
        ("u2", 2, 1, 1, 2),
        ("u3", 2, None, None, None),
    ]


def test_member_topline_defaults(spark):
    top = spark.createDataFrame([("u1", 5), ("u2", 6)], "user_id string, users int")
    known = spark.createDataFrame([("v1", "Early Voted", "Has Voted!", 10)], "myv_van_id string, voting_status_raw string, voting_status string, voting_status_priority int")
    ids = spark.createDataFrame([("u1", "v1")], "reach_user_id string, myv_van_id string")
    seen = spark.createDataFrame([("u1", 0, "Today")], "user_id string, last_activity int, last_activity_readable string")
    out = topline.member_topline(top, known, ids, seen)
    assert sets(out, "user_id", "voting_status", "voting_status_priority") == [
        ("u1", "Has Voted!", 10),
        ("u2", "Unable to match to Voter File", 5),
    ]


def test_work_queue_texts_use_the_joined_tier(frame, spark):
    edges = frame("relationships", [dict(user_id="u", reach_id=r, relationship_status="Active", person_first_name=r) for r in "abc"])
    member = spark.createDataFrame([("u", "rmm")], "user_id string, rmm string")
    wide = spark.createDataFrame([("a", 2), ("b", 3)], "reach_id string, support_id_numeric bigint")
    state = spark.createDataFrame([("a", "s1", "Has Voted!"), ("b", "s2", "Needs to Vote")], "reach_id string, sos_id string, voting_status string")
    tier = spark.createDataFrame([("a", 2), ("c", 1)], "reach_id string, tier int")
    out = queues.work_queue(edges, member, wide, state, tier)
    assert sets(out, "voter", "sos_id", "tier", "tier_str", "sort_1", "sort_2") == [
        ("a", "s1", 2, "Tier 2", 10, 10),
        ("b", "s2", None, "Not a Target", 0, 5),
        ("c", "Reach Add", 4, "Tier 1", 5, 3),
    ]


def test_volunteers(frame, spark):
    users = frame("users", [dict(user_id=u, first_name=u) for u in ("m", "v", "w")])
    member = spark.createDataFrame([("m",), ("m",)], "user_id string")
    edges = frame(
        "relationships",
        [dict(user_id=u, user_name=u, reach_id=r, auto_applied_tag=t, state_file_id=s) for u, r, t, s in
         [("v", "a", "Voter", "GA_1"), ("v", "a", "Voter", None), ("v", "b", "Voter", "GA_2"), ("v", "c", "Reach Add", None),
          ("m", "a", "Voter", "GA_1")]],
    )
    state = spark.createDataFrame([("a", "Early Voted"), ("a", "Needs to Vote"), ("b", "Needs to Vote"), ("c", "Early Voted")], "reach_id string, voting_status_raw string")
    out = queues.volunteer_users(users, member, edges, state)
    assert sets(out, "user_id", "voters", "matched_voters", "voters_voted") == [("v", 3, 2, 1), ("w", 0, 0, 0)]
    wide = spark.createDataFrame([], "reach_id string, support_id string, vote_plan string, detailed_plan string, vol_ask string")
    people = queues.volunteer_people(edges, member, wide, state)
    assert sets(people, "reach_id", "user_id", "voting_status") == [("a", "v", ""), ("b", "v", "")]


# --- lists ------------------------------------------------------------------------------------------


def test_not_enrolled_with_a_null_note(frame):
    users = frame("users", [dict(user_id="1"), dict(user_id="2")])
    notes = frame("notes", [dict(note_text=t, note_category_name="ID") for t in ("1", None)] + [dict(note_text="2", note_category_name="x")])
    assert sets(lists.not_enrolled(users, notes, "ID"), "user_id") == [("2",)]
    assert lists.not_enrolled(users, notes, "ID", null_aware=True).count() == 0


def test_segments_put_unknown_states_with_everyone_else(frame):
    users = frame("users", [dict(user_id=u, state=s) for u, s in [("m", "NY"), ("a", "NY"), ("b", "GA"), ("c", None)]])
    member = frame("users", [dict(user_id="m")])
    groups = {"member": "M", "out_of_state": "O", "everyone_else": "E"}
    out = lists.user_segments(users, member, "GA", groups)
    assert sets(out) == [("a", "O"), ("b", "E"), ("c", "E"), ("m", "M")]


def test_uncontactable(frame, cross, file, absentee, spark):
    state = status.vote_status(cross, file, absentee)
    phones = frame("phone_numbers", [dict(myv_van_id="v3", phone_number="1"), dict(myv_van_id="v4", phone_number=None)])
    support = spark.createDataFrame([("p5", 49.0), ("p7", 50.0)], "person_id string, support_score double")
    tags = frame("tag_history", [dict(state_file_id=s, tag_id=t, tag_action=a) for s, t, a in
                                 [("GA_s8", "T", "Added"), ("GA_s7", "T", "Removed"), ("GA_s4", "other", "Added"), (None, "T", "Added")]])
    out = lists.uncontactable(state, file, cross, phones, support, tags, "T", "GA_")
    assert sets(out) == [("GA_s4",), ("GA_s6",), ("GA_s7",)]
    assert lists.uncontactable(state, file, cross, phones, support, tags, "T", "GA_", null_aware=True).count() == 0


def test_support_scores(frame):
    external = frame("external_responses", [dict(person_id=p, master_survey_question_id="q", master_survey_response_id=a, msq_currency=c)
                                            for p, a, c in [("1", "for", 1), ("2", "mid", 1), ("3", "con", 1), ("4", "for", 0), ("1", "for", 1)]])
    scores = frame("scores", [dict(person_id=p, model_support_score=7.0) for p in ("1", "3", "4", "5")])
    out = lists.support_scores(external, scores, CODES)
    assert sets(out) == [("1", 100.0), ("2", 50.0), ("3", 7.0), ("4", 7.0), ("5", 7.0)]


def test_profile_full_join_keeps_people_known_to_one_source(spark, cross, file, absentee):
    wide = spark.createDataFrame([("only-answers", 3, "p")], "reach_id string, support_id_numeric bigint, vote_plan string")
    tier = spark.createDataFrame([("p1", 1)], "person_id string, tier int")
    out = topline.person_profile(status.vote_status(cross, file, absentee), wide, tier, file, cross)
    found = {r.reach_id: r for r in out.collect()}
    assert found["only-answers"].nonvoting is None and found["r6"].nonvoting and not found["r2"].nonvoting
    assert (found["r1"].tier1, found["r1"].records) == (1, 1)
    assert out.groupBy("reach_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count() == 0


def test_days_follow_the_earliest_timestamp(spark, frame):
    """The day is that of the earliest row, also where a later row names an earlier day."""
    edge = dict(user_id="u", reach_id="r", relationship_status="Active")
    edges = frame(
        "relationships",
        [
            dict(edge, relationship_created_timestamp=dt.datetime(2024, 1, 2, 9), relationship_created_date=D(2024, 1, 2)),
            dict(edge, relationship_created_timestamp=dt.datetime(2024, 1, 3, 9), relationship_created_date=D(2024, 1, 1)),
        ],
    )
    assert [r.first_day for r in growth.touches(edges).collect()] == [D(2024, 1, 2)]
