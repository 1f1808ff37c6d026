"""Large pretty-printed objects are read by many tasks and give what one task reads."""

import datetime as dt
import json

import pytest
from frames import sets
from pyspark.sql import DataFrameWriter

from rapport.plans import nested
from rapport.sources import files, pretty

UNTIL = dt.date(2024, 1, 30)


def person(k):
    return dict(voter=f'P {k} "q" {{[', support_id="a\\b", support_id_numeric="1", vote_plan="}],", detailed_plan="x\ny", vol_ask="")


def org(pods, leaders, people):
    member = lambda k: dict(user_id=str(k), user_name=f"u{k}", network=[person(j) for j in range(people)])
    return {f'pod "{p}" {{': [dict(rmm=f"r{p}-{n}", cms=[member(n)]) for n in range(leaders)] for p in range(pods)}


@pytest.fixture
def small_splits(spark):
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(key, "4KB")
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("indent", [1, 2, "\t"])
def test_one_object_is_read_by_many_tasks(spark, tmp_path, small_splits, indent):
    for n, doc in enumerate([org(3, 20, 4), {**org(1, 2, 1), "empty": []}, {}]):
        (tmp_path / f"{n}.json").write_text(json.dumps(doc, indent=indent))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    one = nested.flatten_org(files.read_org(spark, str(tmp_path), whole_file=True), UNTIL)
    many = nested.flatten_org(pretty.read_pretty_org(spark, str(tmp_path)), UNTIL)
    assert sets(many) == sets(one) and one.count() == 3 * 20 * 4 + 2


def test_written_objects_are_json_and_come_back(spark, tmp_path):
    text = json.dumps(org(2, 3, 2))
    docs = spark.createDataFrame([(text,)], "value string")
    docs.write.text(str(tmp_path / "in"))
    docs = files.read_org(spark, str(tmp_path / "in"))
    pretty.write_pretty_org(docs, str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("part-*.txt")
    assert {k: len(v) for k, v in json.loads(file.read_text()).items()} == {k: 3 for k in org(2, 3, 2)}
    assert sets(nested.flatten_org(pretty.read_pretty_org(spark, str(tmp_path / "out")), UNTIL)) == sets(nested.flatten_org(docs, UNTIL))


def test_no_task_sorts_or_prints_the_whole_object(spark, tmp_path, small_splits):
    """Sorted and printed by many tasks, the file is copied by one that holds a leader at a time; strings stay as they are."""
    doc = org(3, 30, 2)
    doc['pod "0" {'][0]["cms"][0]["user_name"] = "a\u2028  b\u0085  c\n  d  "
    docs = spark.createDataFrame([(json.dumps({pod: [leader]}),) for pod, leaders in doc.items() for leader in leaders], "value string")
    docs.write.text(str(tmp_path / "in"))
    docs = files.read_org(spark, str(tmp_path / "in"))
    sorts, write = [], DataFrameWriter.text

    def watched(writer, path, *args, **kwargs):
        if path == str(tmp_path / "out"):
            sorts.append(writer._df._jdf.queryExecution().executedPlan().toString())
        write(writer, path, *args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "text", watched)
        pretty.write_pretty_org(docs, str(tmp_path / "out"))
    assert len(sorts) == 1 and "Sort" not in sorts[0] and "Window" not in sorts[0]
    (file,) = (tmp_path / "out").glob("part-*.txt")
    got = json.loads(file.read_text())
    order = lambda leaders: sorted(x["rmm"] for x in leaders)
    assert {k: order(v) for k, v in got.items()} == {k: order(v) for k, v in doc.items()}
    many = nested.flatten_org(pretty.read_pretty_org(spark, str(tmp_path / "out")), UNTIL)
    assert sets(many) == sets(nested.flatten_org(docs, UNTIL)) and many.count() == 180


def test_records_and_names_go_over_borders_of_splits(spark, tmp_path, small_splits):
    """Records longer than a split, names far ahead of their records, and lists behind them."""
    doc = {**org(2, 40, 1), **{f"big{n}": [dict(rmm=f"b{n}", cms=org(1, 1, 300)['pod "0" {'][0]["cms"])] for n in range(3)}, "none": []}
    (tmp_path / "x.json").write_text(json.dumps(doc, indent=2))
    read = pretty.read_pretty_org(spark, str(tmp_path))
    one = files.read_org(spark, str(tmp_path), whole_file=True)
    assert sets(nested.flatten_org(read, UNTIL)) == sets(nested.flatten_org(one, UNTIL))
    assert read.count() == 83


@pytest.mark.parametrize("text", ['{\n"p": [\n{"rmm": "r"\n}\n]\n', '{\n"p": [\n{"rmm": [}\n]\n]\n}'])
def test_broken_objects_fail_the_read(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        pretty.read_pretty_org(spark, str(tmp_path)).collect()
