"""One key holds a third of all rows and more; the sliced way must agree with
the plain one, and must really be taken."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import nested
from tallyspark.functions.exact import cents
from tallyspark.operators import aggregates, joins, ordered, sessions, windows
from tallyspark.operators.ordered import Limits
from tallyspark.sources.tables import load

TIGHT = Limits(rows_per_task=60)


@pytest.fixture(scope="module")
def skewed(spark, small):
    """Events where user 7 (and the null user) hold a third each; times come
    in clumps, with ties."""
    user = (
        F.when(F.col("event_id") % 3 == 0, F.lit(7))
        .when(F.col("event_id") % 3 == 1, F.lit(None).cast("bigint"))
        .otherwise(F.col("user_id"))
    )
    clumped = F.expr("ts - make_dt_interval(0, 0, 0, minute(ts) % 10 * 60 + second(ts))")
    events = load(spark, small, "events").withColumns({"user_id": user.cast("bigint"), "ts": clumped})
    maybe = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    return events.withColumn("value", maybe).repartition(5).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def agree(make, spark):
    """The same rows and types with tight limits and with none."""
    plain, tight = make(ordered.DEFAULT), make(TIGHT)
    assert plain.schema.simpleString() == tight.schema.simpleString()
    want = rows(plain)
    assert want and rows(tight) == want


def test_hot_keys_are_found(skewed):
    found = {row[0] for row in ordered.hot_groups(skewed, ["user_id"], TIGHT).collect()}
    assert found == {7, None}


def test_the_hot_key_is_spread(skewed):
    _, hot, slices = ordered.split_hot(skewed, ["user_id"], TIGHT)
    sliced = ordered.cut(hot, ["user_id"], [F.asc("ts"), F.asc("event_id")], slices)
    sizes = [r["count"] for r in sliced.groupBy("user_id", "_slice").count().collect()]
    assert slices >= 10 and max(sizes) <= 3 * TIGHT.rows_per_task


def test_a_sample_finds_them_too(skewed):
    limits = Limits(rows_per_task=100, sample_hits=50)
    assert limits.fraction == 0.5
    assert {row[0] for row in ordered.hot_groups(skewed, ["user_id"], limits).collect()} == {7, None}


def test_change(spark, skewed):
    order = [F.asc("ts"), F.asc("event_id")]
    agree(lambda lim: windows.change(skewed, ["user_id"], order, ["event_type", "value"], lim), spark)


def test_following(spark, skewed):
    order = [F.desc("ts"), F.desc("event_id")]
    agree(lambda lim: windows.following(skewed, ["user_id"], order, ["value"], lim), spark)


def test_descending_order_with_nulls(spark, skewed):
    order = [F.desc_nulls_first("value"), F.asc("event_id")]
    agree(lambda lim: windows.change(skewed, ["user_id"], order, ["value"], lim), spark)


def test_running(spark, skewed):
    order = [F.asc("ts"), F.asc("event_id")]
    totals = {"t": cents("value"), "n": F.lit(1)}
    agree(lambda lim: windows.running(skewed, ["user_id"], order, totals, lim), spark)


def test_ranks(spark, skewed):
    order = [F.asc("ts"), F.asc("event_id")]
    for tiles in (4, 1000):
        agree(lambda lim: windows.ranks(skewed, ["user_id"], order, ["ts"], tiles, lim), spark)


def test_moving(spark, skewed):
    sums = {"n": F.lit(1), "t": cents("value")}
    agree(lambda lim: windows.moving(skewed, ["user_id"], "ts", 3600, sums, lim), spark)


def test_moving_equals_spark_range_frame(skewed):
    frame = "over (partition by user_id order by ts range between interval 1 hour preceding and current row)"
    value = "coalesce(cast(rint(value * 100) as decimal(18,0)), 0)"
    want = skewed.select("event_id", F.expr(f"count(*) {frame}"), F.expr(f"sum({value}) {frame}"))
    ours = windows.moving(skewed, ["user_id"], "ts", 3600, {"n": F.lit(1), "t": cents("value")})
    assert rows(ours.select("event_id", "n", "t")) == rows(want)


def test_moving_with_missing_times(spark, skewed):
    holes = skewed.withColumn("ts", F.when(F.col("event_id") % 4 != 0, F.col("ts")))
    sums = {"n": F.lit(1)}
    agree(lambda lim: windows.moving(holes, ["user_id"], "ts", 3600, sums, lim), spark)
    frame = "over (partition by user_id order by ts range between interval 1 hour preceding and current row)"
    want = holes.select("event_id", F.expr(f"count(*) {frame}"))
    assert rows(windows.moving(holes, ["user_id"], "ts", 3600, sums).select("event_id", "n")) == rows(want)


def test_top_per(spark, skewed):
    order = [F.asc("ts"), F.asc("event_id")]
    for n in (3, windows.MAP_SIDE_LIMIT + 1):
        agree(lambda lim: windows.top_per(skewed, ["user_id"], order, n, lim), spark)
    by_limit = windows.top_per(skewed, ["user_id"], order, windows.MAP_SIDE_LIMIT)
    by_scan = windows.top_per(skewed, ["user_id"], order, windows.MAP_SIDE_LIMIT + 1, TIGHT)
    assert rows(by_limit) == rows(by_scan.where(F.col("row_number") <= windows.MAP_SIDE_LIMIT))


def test_newest_list(spark, skewed):
    order = [F.desc("ts"), F.desc("event_id")]
    n = windows.MAP_SIDE_LIMIT + 50
    agree(lambda lim: nested.newest_list(skewed, ["user_id"], order, F.col("event_id"), n, lim), spark)


def test_as_of(spark, skewed):
    left = skewed.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = skewed.where(F.col("event_type") == "click").select(
        "event_id", "user_id", "ts", F.col("event_id").alias("click"), "value"
    )
    agree(lambda lim: joins.as_of(left, right, ["user_id"], "ts", "event_id", ["click", "value"], lim), spark)


def test_count_within(spark, skewed):
    left = skewed.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = skewed.where(F.col("event_type") == "click").select("user_id", "ts", "value")
    agree(lambda lim: joins.count_within(left, right, ["user_id"], "ts", 7200, cents("value"), lim), spark)


def test_exact_quantiles(spark, skewed):
    wanted = {"low": 0.1, "median": 0.5, "high": 0.99}
    agree(lambda lim: aggregates.exact_quantiles(skewed, ["user_id"], cents("value"), wanted, lim), spark)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer(spark, skewed, how):
    """Hot on both sides, null keys included, and unmatched keys on each."""
    left = skewed.select(F.col("user_id").alias("a"), F.col("event_id").alias("x")).where("x % 2 = 0 or a > 100")
    right = skewed.select(F.col("user_id").alias("b"), F.col("event_id").alias("y")).where("y % 2 = 1 and (b < 100 or b is null)")
    make = lambda lim: joins.outer(left, right, [("a", "b")], how, {"x": -1}, lim)
    agree(make, spark)
    want = left.join(right, F.col("a") == F.col("b"), how).withColumn("x", F.coalesce("x", F.lit(-1)))
    assert rows(make(TIGHT)) == rows(want)


def test_outer_with_keys_of_unequal_width(spark, skewed):
    left = spark.range(10).select(F.col("id").cast("int").alias("a"))
    right = skewed.select((F.col("user_id") + 3_000_000_000).alias("b")).unionByName(
        spark.range(3).select(F.col("id").alias("b"))
    )
    out = joins.outer(left, right, [("a", "b")], "left", None, TIGHT)
    assert out.where("b is not null").count() == 3 and out.count() == 10


def test_sessions(spark, skewed):
    agree(lambda lim: sessions.sessions(skewed, "user_id", "ts", 1200, cents("value"), lim), spark)


def test_sessions_of_a_gap_shorter_than_the_silences(spark, monkeypatch):
    """One user, an event each ten seconds, a gap of one: every cell is a session."""
    events = spark.range(600).select(
        F.lit(1).alias("user_id"), F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz").alias("ts"), F.lit(2).alias("v")
    )
    whole = []
    monkeypatch.setattr(sessions, "_chained", lambda runs, by, gap, f=sessions._chained: whole.append(runs.count()) or f(runs, by, gap))
    got = sessions.sessions(events, "user_id", "ts", 1, F.col("v"), TIGHT)
    assert whole == [0]  # no hot key goes through one window
    assert got.count() == 600
    assert got.agg(F.sum("events"), F.sum("total"), F.max("events")).first() == (600, 1200, 1)
    far = sessions.sessions(events, "user_id", "ts", 10, F.col("v"), TIGHT).collect()
    assert [(r.events, r.total) for r in far] == [(600, 1200)]


def test_funnel(spark, skewed):
    steps = ["view", "click", "purchase", "error"]
    agree(lambda lim: sessions.funnel(skewed, "user_id", "ts", "event_type", steps, lim), spark)
