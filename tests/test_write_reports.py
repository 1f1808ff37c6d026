"""The whole set of reports written out, from declared tables and from the given ones."""

from frames import SF, sets

from rapport.reports import Reports, write_reports
from rapport.schemas import TABLES
from rapport.sources import sinks
from workloads.queries import PARAMS, QUERIES, Data


def test_all_reports_are_written(spark, tmp_path):
    data = Data(spark, SF)
    paths = write_reports(data, str(tmp_path))
    assert set(paths) == set(data.by_name())
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert len(read["growth_program"].collect()) == 16
    assert sets(read["delta"]) == sets(QUERIES["delta_sync"](spark, SF))
    columns = QUERIES["work_queue"](spark, SF).columns
    assert sets(read["work_queue"], *columns) == sets(QUERIES["work_queue"](spark, SF), *columns)
    days = [r.action_timestamp for r in read["activity_feed"].select("action_timestamp").collect()]
    assert days == sorted(days, reverse=True)
    assert not data.copies and not data.built


def test_one_report_stores_what_it_reads_twice(spark, tmp_path, monkeypatch):
    """Which views are stored follows from the report, and their copies go after the write."""
    kept = []
    monkeypatch.setattr(sinks, "scratch", lambda spark, label: kept.append(label) or str(tmp_path / "scratch" / label))
    write_reports(Data(spark, SF), str(tmp_path / "out"), ["topline_cm"])
    assert {"members", "status"} <= set(kept) and len(kept) == len(set(kept))
    assert not list((tmp_path / "scratch").iterdir())


def test_reports_over_declared_tables(spark, frame, tmp_path):
    """Empty tables with the declared schemas are enough to plan every report."""
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in" / name))
    reports = Reports.over(spark, str(tmp_path / "in"), PARAMS_ONE_ORDER)
    assert all(build().columns for build in reports.by_name().values())
    assert reports.delta.isEmpty() and reports.growth(PARAMS.levels[3]).isEmpty()
    assert reports.match_errors().isEmpty() and reports.status.isEmpty()


PARAMS_ONE_ORDER = PARAMS.__class__(**{**PARAMS.__dict__, "tag_order": ("tag_timestamp", "tag_id")})
