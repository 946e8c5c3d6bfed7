"""A key with a third of all rows must be split by adaptive execution in each
join that relies on it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import joins
from tallyspark.operators.ordered import Limits

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture(scope="module")
def eager_splits(spark):
    """Thresholds as low as the data is small."""
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def facts(spark, eager_splits):
    key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)))
    return spark.range(0, 60_000, 1, 12).select(
        F.col("id").alias("row"), key.cast("bigint").alias("k"), F.hex(F.xxhash64("id")).alias("load")
    )


@pytest.fixture(scope="module")
def dims(spark, eager_splits):
    return spark.range(400).select(F.col("id").alias("d"), F.concat(F.lit("name "), "id").alias("name"))


def ran(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_inner_join_is_split(facts, dims):
    joined = joins.star(facts, [(dims, "k", "d")])
    assert "skew=true" in ran(joined)
    assert joined.count() == facts.where("k < 400").count()


def test_split_goes_on_under_an_aggregate_of_the_same_key(facts, dims):
    grouped = joins.star(facts, [(dims, "k", "d")]).groupBy("k").agg(F.max("load").alias("top"))
    assert "skew=true" in ran(grouped)


@pytest.mark.parametrize("how", ["having_match", "without_match"])
def test_semi_and_anti_join_are_split(facts, dims, how):
    out = getattr(joins, how)(facts, dims, [("k", "d")])
    assert "skew=true" in ran(out)
    wanted = "k < 400" if how == "having_match" else "k >= 400"
    assert out.count() == facts.where(wanted).count()


def test_hot_key_on_the_null_side_of_an_outer_join(facts, dims):
    """Spark alone cannot split this one."""
    limits = Limits(rows_per_task=5_000)
    out = joins.outer(dims, facts, [("d", "k")], "left", {"load": ""}, limits)
    assert "skew=true" in ran(out)
    plain = dims.join(facts, F.col("d") == F.col("k"), "left")
    assert "skew=true" not in ran(plain)
    assert out.count() == plain.count()


def test_interval_join_spreads_a_key_by_time(spark, eager_splits, small):
    """Neighbouring cells only: far fewer candidates than pairs of one key."""
    ts = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 60)")
    left = spark.range(3_000).select(F.lit(1).alias("u"), F.col("id").alias("l"), ts.alias("at"))
    right = spark.range(3_000).select(F.lit(1).alias("w"), F.col("id").alias("r"), ts.alias("was"))
    out = joins.within(left, right, ("u", "w"), ("at", "was"), 600)
    text = ran(out)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert out.count() == sum(min(i, 10) + 1 for i in range(3_000))
