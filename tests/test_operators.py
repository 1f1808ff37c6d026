import random

import pytest
from frames import plan_of, sets
from pyspark.sql import Window
from pyspark.sql import functions as F

from rapport import operators as ops


@pytest.fixture
def rows(spark):
    data = [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", 2, "q"), (None, 5, "n"), (None, 4, "m"), ("c", None, "w")]
    return spark.createDataFrame(data, "k string, ts int, v string")


def test_latest_keeps_ties_and_null_keys(rows):
    assert sets(ops.latest_ties(rows, ["k"], "ts")) == sets(rows.where("v IN ('z', 'y', 'q', 'n')"))


def test_ties_break_either_way(rows):
    latest = ops.latest_ties(rows, ["k"], "ts")
    assert dict(sets(ops.break_ties(latest, ["k"], "v", "min")))["a"] == "y"
    assert dict(sets(ops.break_ties(latest, ["k"], "v", "max")))["a"] == "z"


@pytest.mark.parametrize("how", ["min", "max"])
def test_latest_value_is_latest_then_tie_break(spark, how):
    rng = random.Random(1)
    data = [(rng.choice("abcd"), rng.choice([None, 1, 2, 3]), rng.choice("pqrst")) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, ts int, v string")
    two_steps = ops.break_ties(ops.latest_ties(df, ["k"], "ts"), ["k"], "v", how)
    assert sets(ops.latest_value(df, ["k"], "ts", "v", how), "k", "v") == sets(two_steps)


def test_latest_matches_the_window_form(spark):
    rng = random.Random(2)
    data = [(rng.choice("abc"), rng.choice([None, "u", "v"]), rng.randint(1, 5), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, g string, ts int, id int")
    top = F.max("ts").over(Window.partitionBy("k", "g"))
    assert sets(ops.latest_ties(df, ["k", "g"], "ts")) == sets(df.withColumn("t", top).where("ts = t").drop("t"))
    low = F.min("ts").over(Window.partitionBy("k", "g"))
    assert sets(ops.first_touch(df, "k", ["g"], "ts")) == sets(df.withColumn("t", low).where("ts = t").drop("t"))


def test_latest_one_limits_each_key_before_the_shuffle(rows):
    one = ops.latest_one(rows, ["k"], [F.col("ts").desc_nulls_last(), F.col("v")])
    assert sets(one) == [("a", 3, "y"), ("b", 2, "q"), ("c", None, "w"), (None, 5, "n")]
    assert "WindowGroupLimit" in plan_of(one)


def test_incomplete_first_answer_hides_later_ones(spark):
    data = [("q", 1, 10, None, 10), ("q", 1, 12, 7, 12), ("q", 2, 11, 5, 11), ("q", 2, 11, None, 11), ("q", 3, 9, 1, 9)]
    df = spark.createDataFrame(data, "q string, id int, ts int, response int, day int")
    assert sets(ops.first_answer(df, "q", "id", "ts", "response", "day")) == [("q", 2, 11), ("q", 3, 9)]


def test_anti_default_ignores_nulls_in_the_list(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(2,), (None,)], "id int")
    assert sets(ops.anti(left, right, "id")) == [(1,), (None,)]


@pytest.mark.parametrize(
    "listed, kept", [([], [(1,), (2,), (None,)]), ([2], [(1,)]), ([2, None], []), ([None], [])]
)
def test_null_aware_anti_is_sql_not_in(spark, listed, kept):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(v,) for v in listed], "id int")
    anti = ops.anti(left, right, "id", null_aware=True)
    left.createOrReplaceTempView("l"), right.createOrReplaceTempView("r")
    assert sets(anti) == sets(spark.sql("SELECT id FROM l WHERE id NOT IN (SELECT id FROM r)")) == kept
    assert "NestedLoop" not in plan_of(anti)


def test_mark_join_never_gives_null(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    assert sets(ops.mark_join(left, right, "id", "known")) == [(1, False), (2, True), (None, False)]


@pytest.mark.parametrize("listed", [[], [2], [2, 2, None], [None]])
def test_three_valued_mark_is_sql_in(spark, listed):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(v,) for v in listed], "id int")
    marked = ops.mark_join(left, right, "id", "known", three_valued=True)
    duckdb = pytest.importorskip("duckdb")
    rows = ", ".join(f"({'NULL' if v is None else v})" for v in listed)
    source = f"(SELECT CAST(v AS int) FROM (VALUES {rows}) t(v))" if listed else "(SELECT 1 WHERE false)"
    expected = duckdb.sql(f"SELECT id, id IN {source} FROM (VALUES (1), (2), (NULL)) l(id)").fetchall()
    assert sets(marked) == sorted(expected, key=repr)
    assert "NestedLoop" not in plan_of(marked)


def test_household_expansion(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None), ("e", None)], "sos string, home int")
    seed = spark.createDataFrame([("a",), ("d",), ("zz",), (None,)], "sos string")
    assert sets(ops.expand_by_shared_key(seed, base, "sos", "home")) == [("a",), ("b",)]


def test_distinct_counts(spark):
    data = [("u", 1, "v"), ("u", 1, "w"), ("u", 2, None), ("u", None, "v"), ("t", None, "v")]
    df = spark.createDataFrame(data, "u string, id int, tag string")
    out = ops.distinct_counts(df, ["u"], "id", {"n": None, "v": F.col("tag") == "v"})
    assert sets(out) == [("t", 0, 0), ("u", 2, 1)]


def test_share_of_max(spark):
    df = spark.createDataFrame([("g", 1, 2.0), ("g", 2, 4.0), (None, 1, 0.0)], "g string, day int, users double")
    assert sets(ops.share_of_max(df, "g", ["users"])) == [("g", 1, 0.5), ("g", 2, 1.0), (None, 1, None)]


def test_sum_once(spark):
    df = spark.createDataFrame([("g", 1, 5), ("g", 1, 5), ("g", 2, 5)], "g string, u int, d int")
    assert sets(ops.sum_once(df, ["g"], ["u"], "d", "days")) == [("g", 10)]


def test_frequency(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "x int")
    assert sets(ops.frequency(df, F.col("x").isNull(), "missing")) == [(False, 1), (True, 2)]


@pytest.mark.parametrize("partitions", [1, 4, 64])
@pytest.mark.parametrize("n", [1, 7, 1000])
def test_batches_hold_every_id_once(spark, partitions, n):
    df = spark.range(523).select("id", F.when(F.col("id") < 400, "hot").when(F.col("id") < 520, "warm").alias("k"))
    out = ops.bounded_batches(df.repartition(partitions), "k", "id", n)
    assert sorted(r.id for r in out.collect()) == list(range(523))
    sizes = out.groupBy("k", "batch_no").count().agg(F.max("count")).first()[0]
    assert sizes <= n


def test_copies_of_one_id_are_spread_over_buckets(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("k").alias("k"), F.lit(1).alias("id"))
    slots = ops.batching._slots(df, "k", "id", 10, repeated=True)
    assert slots.select("_bucket").distinct().count() > 1
    out = ops.bounded_batches(df, "k", "id", 10, repeated=True)
    assert out.count() == 4000 and out.groupBy("batch_no").count().agg(F.max("count")).first()[0] <= 10


def test_hot_batches_are_numbered_by_bucket(spark, shuffled_joins):
    df = spark.range(1000).select("id", F.when(F.col("id") % 9 > 0, "hot").otherwise("warm").alias("k"))
    slots = ops.batching._slots(df, "k", "id", 10, repeated=False)
    plan = plan_of(slots.groupBy("k", *ops.batching.SLOT).agg(F.collect_list("id")))
    windows = plan[: plan.index("Window [row_number")]
    assert "Exchange" not in windows.split("Initial Plan")[-1]
    below = plan[plan.index("Window [row_number") :]
    assert below[below.index("Exchange hashpartitioning(") :].startswith("Exchange hashpartitioning(k#")
    assert "_bucket#" in below[below.index("Exchange hashpartitioning(") :].split(")")[0]


@pytest.mark.parametrize("partitions", [1, 5])
def test_dense_index_is_a_permutation_at_any_partitioning(spark, partitions):
    df = spark.range(500).repartition(partitions)
    out = {r.id: r.idx for r in ops.dense_index(df, "id", 3, groups=4).collect()}
    assert sorted(out.values()) == list(range(500))
    assert out == {r.id: r.idx for r in ops.dense_index(spark.range(500), "id", 3).collect()}


def test_one_more_row_moves_indexes_by_one_at_most(spark):
    before = {r.id: r.idx for r in ops.dense_index(spark.range(500), "id", 3).collect()}
    after = {r.id: r.idx for r in ops.dense_index(spark.range(501), "id", 3).collect()}
    assert {after[k] - before[k] for k in before} <= {0, 1}
    plan = plan_of(ops.dense_index(spark.range(500), "id", 3))
    assert "SinglePartition" not in plan


def test_bootstrap_draws_from_the_distribution(spark):
    dist = spark.range(10).select(F.col("id").alias("row"), (F.col("id") * 10).alias("v"))
    out = ops.bootstrap_assign(spark.range(3000).withColumnRenamed("id", "u"), "u", dist, "row", 1)
    counts = {r["row"]: r["count"] for r in out.groupBy("row").count().collect()}
    assert out.count() == 3000 and set(counts) == set(range(10)) and min(counts.values()) > 200
    empty = ops.bootstrap_assign(spark.range(3).withColumnRenamed("id", "u"), "u", dist.where("false"), "row", 1)
    assert empty.count() == 0


def test_weights_are_followed(spark):
    out = ops.weighted_assign(spark.range(5000), "id", {"a": 3, "b": 1, "none": 0}, "w", 2)
    counts = {r["w"]: r["count"] for r in out.groupBy("w").count().collect()}
    assert set(counts) == {"a", "b"} and abs(counts["a"] / 5000 - 0.75) < 0.03


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_is_an_equi_join(spark, how):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k int, v string")
    right = spark.createDataFrame([(2, "x"), (2, "y"), (None, "z"), (3, "w")], "k int, o string")
    assert sets(ops.split_join(left, right, "k", how)) == sets(left.join(right, "k", how))


def test_hot_key_is_split_although_the_other_side_was_aggregated(spark, shuffled_joins):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id"))
        edges = spark.range(0, 60000, 1, 16).select("id", hot.alias("k"))
        summary = edges.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = ops.split_join(edges, summary, "k").groupBy("k", "id").agg(F.max("n").alias("n"))
        assert joined.collect() and "skew=true" in plan_of(joined)
        plain = edges.join(summary, "k").groupBy("k", "id").agg(F.max("n").alias("n"))
        assert plain.collect() and "skew=true" not in plan_of(plain)
        assert sets(joined) == sets(plain)
    finally:
        for key in small:
            spark.conf.unset(key)


@pytest.mark.parametrize("n", [5, 100])
def test_batches_move_wide_rows_once(spark, tmp_path, n):
    """Keys of several batches are few: rows are told apart without a shuffle, whatever their estimated size."""
    rows = spark.range(0, 20000, 1, 4).selectExpr("if(id < 300, -1, id) AS k", "id", "repeat(uuid(), 9) AS wide")
    rows.write.parquet(str(tmp_path / "rows"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
    try:
        stored = spark.read.parquet(str(tmp_path / "rows"))
        out = ops.collect_batches(stored, "k", "id", F.col("wide"), "items", n)
        assert plan_of(out).count("SortMergeJoin") == 0
        assert out.agg(F.sum("batch_size"), F.max(F.size("items"))).first()[:] == (20000, min(n, 300))
        assert out.where("k = -1").count() == -(-300 // n)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
