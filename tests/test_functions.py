import datetime as dt

import pytest
from pyspark.sql import functions as F

import rapport.functions as fn


def values(spark, rows, kind, build):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(build(F.col("x"))).collect()]


def test_clean_phone(spark):
    raw = ["(404) 555-1234", "1-404-555-1234", "+1 404.555.1234", "2-404-555-1234", "555-01", "", None, "1234567890"]
    good = "4045551234"
    assert values(spark, raw, "string", fn.clean_phone) == [good, good, good, None, None, None, None, "1234567890"]


def test_title_case_breaks_on_punctuation_but_not_on_apostrophe(spark):
    raw = ["mary-ann o'neil", "JEAN_LUC d.souza", "a b", "", None, "x--y"]
    expected = ["Mary-Ann O'neil", "Jean_Luc D.Souza", "A B", "", None, "X--Y"]
    assert values(spark, raw, "string", fn.title_case) == expected


def test_full_name_skips_missing_parts(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "f string, l string")
    assert [r[0] for r in df.select(fn.full_name(F.col("f"), F.col("l"))).collect()] == ["a b", "b", "a", ""]


def test_prefixes(spark):
    for prefix in ("A_", "GA_", "WY-12_"):
        ids = [f"{prefix}12_7", prefix, "12", None]
        assert values(spark, ids, "string", lambda c: fn.strip_prefix(c, prefix)) == ["12_7", "", "12", None]
        assert values(spark, ["12", None], "string", lambda c: fn.add_prefix(c, prefix)) == [f"{prefix}12", None]


def test_ratio_is_null_on_zero(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(fn.ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None]


def test_greatest_is_null_as_soon_as_one_value_is(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(fn.greatest_strict(F.col("a"), F.col("b"))).collect()] == [2, None, None]


def test_rounding_sends_halves_to_even(spark):
    assert values(spark, [0.5, 1.5, 2.5, 2.6], "double", fn.round_half_even) == [0.0, 2.0, 2.0, 3.0]


def test_to_int_gives_null_for_text(spark):
    assert values(spark, ["3", "", "x", None], "string", fn.to_int) == [3, None, None, None]


def test_readable_days(spark):
    expected = ["Today", "Yesterday", "5 days ago", "-1 days ago", None]
    assert values(spark, [0, 1, 5, -1, None], "int", fn.readable_days) == expected


def test_today_in_a_zone_is_at_most_a_day_off_utc(spark):
    today = spark.range(1).select(fn.today_in("US/Eastern")).first()[0]
    assert abs((today - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_choices_of_invalid_empty_and_scalar_json(spark):
    raw = ['["a","b"]', "[]", "not json", "", '"scalar"', None]
    assert values(spark, raw, "string", fn.choices) == [["a", "b"], [], None, None, None, None]


def test_choices_text_joins_lines_without_quotes(spark):
    assert values(spark, ['["a \\"x\\"","b"]'], "string", fn.choices_text) == ["a x\nb"]


@pytest.mark.parametrize("seed", [0, 5])
def test_unit_hash_is_uniform_and_repeatable(spark, seed):
    df = spark.range(2000).select(fn.unit_hash(F.col("id"), seed).alias("u"))
    again = spark.range(2000).repartition(7).select(fn.unit_hash(F.col("id"), seed).alias("u"))
    first = sorted(r.u for r in df.collect())
    assert first == sorted(r.u for r in again.collect())
    assert 0 <= first[0] and first[-1] < 1 and abs(sum(first) / len(first) - 0.5) < 0.03
