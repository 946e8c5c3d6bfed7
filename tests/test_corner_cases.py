"""Inputs that the tables lack; expected values are written by hand."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import calendar, text
from tallyspark.functions.udfs import digit_sum, grouped_partials
from tallyspark.operators import aggregates, joins, ordered, windows
from tallyspark.operators.ordered import Limits


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_digit_sum_beside_nulls_and_at_the_ends(spark):
    numbers = [(9007199254740993,), (None,), (-(2**63),), (2**63 - 1,)]
    got = spark.createDataFrame(numbers, "n bigint").coalesce(1).select(digit_sum("n").alias("d"))
    assert [r["d"] for r in got.collect()] == [78, None, 89, 88]


def test_partials_refuse_fractions(spark):
    with pytest.raises(TypeError):
        grouped_partials(spark.createDataFrame([(1, 1.5)], "k int, v double"), ["k"], "v")


def test_levels_need_a_merge_for_each_aggregate(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    with pytest.raises(ValueError):
        aggregates.levels(df, ["k"], "rollup", {"mean": F.avg("v")})


@pytest.mark.parametrize("kind,sets", [("rollup", None), ("cube", None), ("sets", [["k"], []])])
def test_grand_total_of_no_rows(spark, kind, sets):
    df = spark.createDataFrame([("a", 1), (None, 3)], "k string, v int")
    aggs, merge = {"n": F.count(F.lit(1)), "t": F.sum("v")}, {"n": F.sum, "t": F.sum}
    assert rows(aggregates.levels(df.where("v > 5"), ["k"], kind, aggs, sets, merge)) == [(None, 1, 0, None)]
    assert rows(aggregates.levels(df, ["k"], kind, aggs, sets, merge)) == sorted([("a", 0, 1, 1), (None, 0, 1, 3), (None, 1, 2, 4)], key=repr)


def test_growth_across_a_gap(spark):
    df = spark.createDataFrame([(datetime(2024, m, 1), v) for m, v in ((1, 2.0), (4, 4.0), (5, 6.0))], "period timestamp_ntz, v double")
    got = calendar.growth(df, "v", "month").select("v", "previous", "growth")
    assert rows(got) == sorted([(2.0, None, None), (4.0, None, None), (6.0, 4.0, 0.5)], key=repr)


def test_growth_by_quarter_and_hour(spark):
    for unit, second in (("quarter", datetime(2024, 4, 1)), ("hour", datetime(2024, 1, 1, 1))):
        df = spark.createDataFrame([(datetime(2024, 1, 1), 1.0), (second, 3.0)], "period timestamp_ntz, v double")
        assert rows(calendar.growth(df, "v", unit).select("growth").dropna()) == [(2.0,)]


def test_hosts_and_parameters_of_odd_urls(spark):
    urls = ["https://user:pw@Ex.org/p", "http://u@ex.org/", "http://[::1]:8080/x", "http://ex.org/a b?q=1", "http://my_host/x", "none", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1).select(text.host("u").alias("h"))
    assert [r["h"] for r in got.collect()] == ["ex.org", "ex.org", "[::1]", "ex.org", "my_host", "", None]
    odd = spark.createDataFrame([("http://e/?axb=1&a.b=2#frag?utm=3",)], "u string")
    assert odd.select(text.url_parameter("u", "a.b"), text.url_parameter("u", "utm"), text.url_parameter("u", "axb")).first()[:] == ("2", "", "1")
    assert spark.range(1).select(text.title(F.lit("  forest  GREEN "))).first()[0] == "Forest Green"


@pytest.mark.parametrize("limits", [ordered.DEFAULT, Limits(rows_per_task=2)])
@pytest.mark.parametrize(
    "how,want",
    [
        ("left", [(1, None, "x"), (1, None, "y"), (1, None, "z"), (2, 5, "?")]),
        ("right", [(1, None, "x"), (1, None, "y"), (1, None, "z"), (3, -1, "w")]),
        ("full", [(1, None, "x"), (1, None, "y"), (1, None, "z"), (2, 5, "?"), (3, -1, "w")]),
    ],
)
def test_outer_with_one_key_name_fills_unmatched_rows_only(spark, how, want, limits):
    left = spark.createDataFrame([(1, None), (2, 5)], "k int, a int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z"), (3, "w")], "k int, b string")
    got = joins.outer(left, right, [("k", "k")], how, {"a": -1, "b": "?"}, limits)
    assert got.columns == ["k", "a", "b"] and rows(got) == sorted(want, key=repr)


def test_intervals_of_no_width_after_the_left_and_with_two_keys(spark):
    start = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, "a", start)], "u int, g string, at timestamp_ntz")
    around = [(1, "a" if n else "b", start + timedelta(seconds=n), n) for n in (-5, -1, 0, 1, 5)]
    right = spark.createDataFrame(around, "w int, h string, was timestamp_ntz, n int")

    def hits(*args, on=("u", "w")):
        return sorted(r["n"] for r in joins.within(left, right, on, ("at", "was"), *args).collect())

    assert hits(0) == [0] and hits(1) == [-1, 0] and hits(5, 1) == [-5, -1] and hits(1, -1) == [-1, 0, 1] and hits(-1, -5) == [1, 5]
    assert hits(1, -1, on=[("u", "w"), ("g", "h")]) == [-1, 1]
    with pytest.raises(ValueError):
        hits(0, 1)


def test_quantile_of_a_whole_table(spark):
    df = spark.range(1, 6).select(F.col("id").cast("double").alias("v"))
    assert rows(aggregates.exact_quantiles(df, [], F.col("v"), {"median": 0.5, "low": 0.125})) == [(3.0, 1.5)]


def test_more_hot_keys_and_slices_than_any_limit(spark):
    """Every group above the limit is cut, whatever their number."""
    df = spark.range(7500).select((F.col("id") % 1500).alias("k"), F.col("id").alias("v"))
    limits = Limits(rows_per_task=4)
    assert ordered.hot_groups(df, ["k"], limits).count() == 1500
    assert ordered.split_hot(df, ["k"], limits)[2] == 7500 // 4
    few = df.where("k < 40")
    plain = windows.running(few, ["k"], [F.asc("v")], {"t": F.col("v")})
    assert rows(windows.running(few, ["k"], [F.asc("v")], {"t": F.col("v")}, limits)) == rows(plain)
