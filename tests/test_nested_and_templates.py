import datetime as dt
import json

import pytest
from frames import plan_of, sets
from pyspark.sql import functions as F

from rapport.plans import nested, templates, topline
from rapport.sources import files

UNTIL = dt.date(2024, 1, 30)

PERSON = dict(
    voter="P", support_id="yes", support_id_numeric="1", vote_plan="p", detailed_plan="", vol_ask="", triplers="",
    outreach="", sos_id="1", tier="1", tier_str="Tier 1", voting_status="Has Voted!",
)
MEMBER = dict(
    user_id="u", date_joined="2024-01-20", user_name="U", email_address="e", phone_number="1", last_activity="0",
    voting_status="Needs to Vote",
)


@pytest.fixture
def org():
    added = {**PERSON, "sos_id": "Reach Add", "support_id_numeric": "", "vote_plan": "", "voting_status": "", "tier": "4"}
    opened = {**PERSON, "voting_status": "Needs to Vote", "support_id_numeric": "4", "tier": "2"}
    return {
        "Pod A": [
            {"rmm": "R1", "cms": [{**MEMBER, "network": [PERSON, added, opened]}, {**MEMBER, "user_id": "none", "network": []}]},
            {"rmm": "R2", "cms": [{**MEMBER, "user_id": "w", "date_joined": "", "network": [added]}]},
        ],
        "Pod B": [{"rmm": "R3", "cms": []}],
    }


@pytest.fixture
def flat(spark, org, tmp_path):
    (tmp_path / "org.json").write_text(json.dumps(org, indent=1))
    return nested.flatten_org(files.read_org(spark, str(tmp_path / "org.json"), whole_file=True), UNTIL)


def test_flatten_drops_empty_networks_and_renames_the_member_status(flat):
    rows = sets(flat, "pod", "rmm", "user_id", "cm_days", "support_id_numeric", "cm_voting_status", "voting_status")
    assert rows == [
        ("Pod A", "R1", "u", 10, 1, "Needs to Vote", "Has Voted!"),
        ("Pod A", "R1", "u", 10, 4, "Needs to Vote", "Needs to Vote"),
        ("Pod A", "R1", "u", 10, None, "Needs to Vote", ""),
        ("Pod A", "R2", "w", None, None, "Needs to Vote", ""),
    ]


def test_lines_and_whole_files_read_alike(spark, org, flat, tmp_path):
    lines = [json.dumps({pod: leaders}) for pod, leaders in org.items()]
    (tmp_path / "org.jsonl").write_text("\n".join(lines))
    assert sets(nested.flatten_org(files.read_org(spark, str(tmp_path / "org.jsonl")), UNTIL)) == sets(flat)


@pytest.mark.parametrize("most", [1, 2, 1000])
@pytest.mark.parametrize("partitions", [1, 6])
def test_nest_then_flatten_gives_all_rows_back(spark, flat, most, partitions):
    """Copies of one person included, and however a network is cut into documents."""
    copies = flat.unionByName(flat).unionByName(flat).repartition(partitions)
    docs = nested.nest_networks(copies, most)
    text = nested.org_lines(docs).collect()
    biggest = max(len(cm["network"]) for r in text for ls in json.loads(r.value).values() for l in ls for cm in l["cms"])
    assert biggest <= most
    assert sets(nested.flatten_org(docs, UNTIL)) == sets(copies)


def test_member_list_columns(flat):
    assert nested.member_list(flat).columns[:4] == ["user_id", "voter", "user_name", "email_address"]


def test_summary_counts_days_once_per_member(flat):
    row = topline.topline_summary(flat, ["pod"]).first()
    assert (row.users, row.matched_voters, row.reach_adds, row.ids, row.plans, row.votes) == (2, 2, 2, 2, 2, 1)
    assert (row.cm_days, row.avg_support_id, row.pct_votes, row.pct_matched_voters) == (10, 2.5, 0.5, 0.5)
    assert (row.num_nonvoting_voters, row.nonvoting_support_ids, row.pct_nonvoting_plans) == (1, 1, 1.0)
    assert (row.tier1, row.tier2, row.tier3, row.tier4) == (1, 1, 0, 2)
    assert row.voters_per_cm_week == pytest.approx(2 / 10 * 7)
    by_member = {r.user_id: r for r in topline.member_summary(flat).collect()}
    assert by_member["u"].cm_days == 10 and by_member["w"].pct_votes is None
    assert by_member["w"].cm_voting_status == "Needs to Vote"


def test_volunteers_round_trip_and_summary(spark, tmp_path):
    person = dict(
        reach_id="r", auto_applied_tag="Voter", person_first_name="a", person_last_name="b", support_id="", vote_plan="",
        detailed_plan="", vol_ask="", voting_status="Has Voted!", only_reachable_by_reacher="y", triplers="", tier="1",
    )
    user = dict(user_id="u", user_name="U", phone_number="1", date_joined="2024-01-02", zip_code="3", state="GA")
    other = {**person, "auto_applied_tag": "Reach Add", "voting_status": "", "only_reachable_by_reacher": "n"}
    doc = {"users": [{**user, "network": [person, other]}, {**user, "user_id": "x", "network": []}]}
    (tmp_path / "v.json").write_text(json.dumps(doc, indent=2))
    flat = nested.flatten_volunteers(files.read_volunteers(spark, str(tmp_path / "v.json"), whole_file=True))
    assert sets(nested.flatten_volunteers(nested.nest_volunteers(flat, 1))) == sets(flat)
    assert [tuple(r) for r in nested.volunteer_summary(flat).collect()] == [
        ("u", "U", "1", dt.date(2024, 1, 2), 2, 1, 1, 1, "3", "GA")
    ]
    assert nested.volunteer_list(flat).columns == ["reach_id", "user_id", "user_name", *nested.VOLUNTEER_PERSON_FIELDS[1:]]


def test_templates_fit_and_scale(spark):
    rows = [("a", dt.date(2021, 1, d), 5 * d, 10 * d, d, 2.0 * d, d - 1) for d in (1, 2, 9)]
    series = spark.createDataFrame(
        rows, "rmm string, day date, users int, matched_voters int, reach_adds int, voters_per_cm_week double, votes int"
    )
    template = templates.fit_template(series, "rmm", dt.date(2021, 1, 6))
    assert sets(template, "group", "users_ptg", "votes_ptg") == [("a", 0.5, 0.0), ("a", 1.0, 1.0)]
    totals = spark.createDataFrame(
        [("x", 5, 10, 0, 3, 1.5), ("y", 3, 0, 7, 0, 1.0)],
        "pod string, users int, matched_voters int, reach_adds int, votes int, voters_per_cm_week double",
    )
    out = templates.scale_template(totals, template, ["pod"], seed=1)
    got = sets(out.withColumn("day", F.dayofmonth("day")), "pod", "day", "users", "matched_voters", "reach_adds", "votes", "pct_votes")
    # halves go to the even neighbour: 2.5 -> 2, 1.5 -> 2, 3.5 -> 4
    assert got == [
        ("x", 1, 2.0, 5.0, 0.0, 0.0, 0.0),
        ("x", 2, 5.0, 10.0, 0.0, 3.0, 0.3),
        ("y", 1, 2.0, 0.0, 4.0, 0.0, None),
        ("y", 2, 3.0, 0.0, 7.0, 0.0, None),
    ]


def test_topline_template_fills_zero(spark):
    top = spark.createDataFrame([("u", 3, None), ("v", None, 2)], "user_id string, matched_voters bigint, reach_adds bigint")
    users = spark.createDataFrame([("u", dt.date(2024, 1, 1))], "user_id string, date_joined date")
    assert sets(templates.topline_template(top, users)) == [(None, 0, 2), (dt.date(2024, 1, 1), 3, 0)]


def test_few_templates_are_hot_keys_that_are_split(spark, shuffled_joins):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        totals = spark.range(0, 20000, 1, 8).selectExpr("id AS pod", *[f"id % 50 AS {m}" for m in templates.TEMPLATE_MEASURES])
        days = [dt.date(2024, 1, 1 + k) for k in range(4)]
        rows = [(g, day, *[(k + 1) / 4] * 5) for g in ("a", "b") for k, day in enumerate(days)]
        ptg = ", ".join(f"{m}_ptg double" for m in templates.TEMPLATE_MEASURES)
        template = spark.createDataFrame(rows, f"group string, day date, {ptg}")
        out = templates.scale_template(totals, template, ["pod"], seed=1)
        last = out.where(F.col("day") == F.lit(days[-1])).select("pod", "users").join(totals.selectExpr("pod AS p", "users AS u"), F.col("pod") == F.col("p"))
        assert out.count() == 80000 and last.where("users <> u").count() == 0
        assert out.collect() and plan_of(out).count("skew=true") >= 2
    finally:
        for key in small:
            spark.conf.unset(key)


def test_written_lines_are_small_and_come_back(spark, flat, tmp_path):
    many = spark.range(300).crossJoin(flat).drop("id")
    docs = nested.nest_networks(many, 50)
    files.write_lines(nested.org_lines(docs), str(tmp_path / "lines"))
    plain = sum(len(r.value) + 1 for r in nested.org_lines(docs).collect())
    assert sum(f.stat().st_size for f in (tmp_path / "lines").glob("part-*")) < plain / 5
    assert sets(nested.flatten_org(files.read_org(spark, str(tmp_path / "lines")), UNTIL)) == sets(many)
