"""The plan is the point: what must and must not show up in it."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyspark.operators import windows
from tallyspark.session import RUNTIME_CONF, prepare
from tallyspark.sources.tables import load

QUERIES = contract.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def optimized(spark, folder, name):
    return plan(QUERIES[name](spark, folder))


@pytest.fixture
def no_broadcast(spark):
    """As with sides too big to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_prepare_sets_the_runtime_settings(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    prepare(spark)
    assert {k: spark.conf.get(k) for k in RUNTIME_CONF} == RUNTIME_CONF


def test_filters_and_columns_reach_the_scan(spark, small):
    text = optimized(spark, small, "filtered_lineitems")
    assert "LessThan(l_quantity,24.0)" in text and "GreaterThanOrEqual(l_shipdate" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_tax" not in read and "l_returnflag" not in read


def test_only_the_wanted_folder_is_read(spark, small):
    assert re.search(r"PartitionFilters: \[.*y#\d+ = 1997", optimized(spark, small, "partition_pruned_read"))


def test_small_dimensions_are_broadcast(spark, small):
    text = optimized(spark, small, "star_join_revenue")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_dimensions_are_not(spark, small, no_broadcast):
    text = optimized(spark, small, "star_join_revenue")
    assert "SortMergeJoin" in text and "Broadcast" not in text


BATCH = sorted(
    set(QUERIES) - {n for n in QUERIES if n.startswith("streamed_")} - {"hourly_windows", "sliding_windows"}
)


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_and_no_products(spark, small, no_broadcast, name):
    text = optimized(spark, small, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["top_orders_per_customer", "distinct_documents", "orders_upserted", "newest_event_types"])
def test_groups_are_trimmed_before_the_shuffle(spark, small, name):
    assert optimized(spark, small, name).count("WindowGroupLimit") >= 2


def test_texts_are_hashed_and_not_shuffled(spark, small):
    text = optimized(spark, small, "distinct_documents")
    shuffled = re.search(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text).group(1)
    assert "_key_text" in shuffled and not re.search(r"(^|[ ,])text#", shuffled)


@pytest.mark.parametrize("name", ["order_rollup", "order_cube", "order_grouping_sets"])
def test_rows_are_aggregated_before_they_are_rolled_up(spark, small, name):
    text = optimized(spark, small, name)
    tree = text[: text.index("(1) Scan")]
    lines = [line for line in tree.splitlines() if re.search(r"Expand|Exchange|Scan", line)]
    kinds = [re.search(r"(Expand|Exchange|Scan)", line).group(1) for line in lines]
    # From the top: the merging shuffle, the copies per level, the shuffle of the rows' aggregates.
    assert kinds == ["Exchange", "Expand", "Exchange", "Scan"]


def test_top_k_does_not_sort_everything(spark, small):
    assert "TakeOrderedAndProject" in optimized(spark, small, "dearest_orders")
    assert "TakeOrderedAndProject" in optimized(spark, small, "nearest_vectors")


@pytest.mark.parametrize("name", ["event_gaps", "running_value", "moving_hour", "last_click_before_purchase", "order_ranks"])
def test_one_shuffle_for_ordinary_groups(spark, small, name):
    assert len(re.findall(r"^\(\d+\) Exchange", optimized(spark, small, name), re.M)) == 1


def test_aggregates_combine_before_the_shuffle(spark, small):
    text = optimized(spark, small, "pricing_summary")
    assert text.count("partial_sum") >= 4 and "l_orderkey" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)


def test_python_sees_only_needed_columns(spark, small):
    text = optimized(spark, small, "line_quantity_partials")
    assert "MapInArrow" in text
    assert set(re.search(r"ReadSchema: struct<([^>]*)>", text).group(1).split(",")) == {
        "l_quantity:double", "l_returnflag:string", "l_linestatus:string"
    }


def test_moving_sums_keep_linear_frames(spark, small):
    events = load(spark, small, "events")
    text = plan(windows.moving(events, ["user_id"], "ts", 60, {"n": F.lit(1)}))
    frames = re.findall(r"specifiedwindowframe\(RangeFrame, (\w+)", text)
    assert frames and set(frames) == {"unboundedpreceding"}
