"""Tables by day and in buckets: what plans read, and what a refresh writes."""

import datetime as dt

import pytest
from frames import plan_of, sets
from pyspark.sql import functions as F

from rapport import operators as ops
from rapport.sources import layout, sheets, sinks

KIND = "id long, ts timestamp, day date"


def events(spark, *days):
    rows = [(100 * d + k, dt.datetime(2024, 1, d, 8 + k), dt.date(2024, 1, d)) for d in days for k in range(3)]
    return spark.createDataFrame(rows, KIND)


def test_a_filter_on_the_day_prunes_folders(spark, tmp_path):
    root = str(tmp_path / "e")
    rows = events(spark, 1, 2, 3, 4).union(spark.createDataFrame([(7, None, None)], KIND))
    layout.write_by_day(rows, root, "day")
    assert sets(layout.read_by_day(spark, root, rows.schema)) == sets(rows)
    some = layout.read_by_day(spark, root, rows.schema, dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert sets(some) == sets(events(spark, 2, 3))
    plan = plan_of(some)
    assert "PartitionFilters: [isnotnull(day" in plan and "day=2024-01-04" not in plan


def test_a_refresh_writes_only_days_with_later_events(spark, tmp_path):
    root = str(tmp_path / "e")
    assert layout.refresh_days(events(spark, 1, 2), root, "day", "ts") == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    stamps = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "e").glob("day=*/*.parquet")}
    assert layout.refresh_days(events(spark, 1, 2, 3), root, "day", "ts") == [dt.date(2024, 1, 3)]
    assert layout.refresh_days(events(spark, 1, 2, 3), root, "day", "ts") == []
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "e").glob("day=*/*.parquet")}
    assert stamps.items() <= after.items() and len(sinks.folders(spark, root)) == 3
    # A later event of the last day: that day is written as a whole, with one that came late.
    more = events(spark, 1, 2, 3).union(spark.createDataFrame([(9, dt.datetime(2024, 1, 3, 23), dt.date(2024, 1, 3)), (8, dt.datetime(2024, 1, 3, 1), dt.date(2024, 1, 3))], KIND))
    assert layout.refresh_days(more, root, "day", "ts") == [dt.date(2024, 1, 3)]
    assert sets(layout.read_by_day(spark, root, more.schema)) == sets(more)


def test_a_refresh_reads_the_source_from_the_watermark_on(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "e")
    layout.write_by_day(events(spark, 1, 2, 3), source, "day")
    table = layout.read_by_day(spark, source, events(spark, 1).schema)
    layout.write_by_day(table.where("day < '2024-01-03'"), root, "day")
    (tmp_path / "source" / "day=2024-01-01").rename(tmp_path / "gone")
    (tmp_path / "source" / "day=2024-01-01").mkdir()
    (tmp_path / "source" / "day=2024-01-01" / "x.parquet").write_text("no parquet: reading this day fails")
    assert layout.refresh_days(table, root, "day", "ts") == [dt.date(2024, 1, 3)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_buckets_join_and_count_without_a_shuffle(spark, shuffled_joins, tmp_path, how):
    edges = spark.range(500).select((F.col("id") % 40).alias("person"), "id")
    people = spark.range(60).select(F.col("id").alias("person"), (F.col("id") * 2).alias("n"))
    for df, name in ((edges, "edges_in_buckets"), (people, "people_in_buckets")):
        layout.write_buckets(df, name, "person", 4, str(tmp_path / name))
    try:
        one, two = spark.table("edges_in_buckets"), spark.table("people_in_buckets")
        joined = ops.split_join(one, two, "person", how, hot=False)
        assert sets(joined) == sets(edges.join(people, "person", how).select(*joined.columns))
        assert "Exchange" not in plan_of(joined) and "Exchange" not in plan_of(one.groupBy("person").count())
        # Against a table that is not in buckets only that one is shuffled.
        assert plan_of(ops.split_join(one, people, "person", how, hot=False)).count("Exchange hash") == 1
    finally:
        for name in ("edges_in_buckets", "people_in_buckets"):
            spark.sql(f"DROP TABLE {name}")


def test_rows_of_a_sheet_are_numbered_through_files_and_splits(spark, tmp_path):
    schema = spark.createDataFrame([], "v string, w string").schema
    rows = [f"row {n}" for n in range(5000)]
    cuts = [0, 3, 3, 2500, 5000]  # one file has a header only
    (tmp_path / "sheet").mkdir()
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / "sheet" / f"{k}.csv").write_text("\n".join(["v,w", *[f"{r},NA" for r in rows[a:b]], ""]) + "\n" * (k % 2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        numbered = sheets.read_numbered(spark, str(tmp_path / "sheet"), schema)
        assert spark.read.csv(str(tmp_path / "sheet")).rdd.getNumPartitions() > 10
        assert {r.row_no: r.v for r in numbered.collect()} == dict(enumerate(rows, 1))
        assert sheets.read_numbered(spark, str(tmp_path / "sheet" / "1.csv"), schema).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
