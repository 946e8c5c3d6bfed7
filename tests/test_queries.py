"""Every named query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tallyspark.sources.tables import SCHEMAS
from tests.compare import differences, duck

# The corpus operators have tests of their own.
NAMES = {name for c in contract.CATALOGUES for name in c.queries}
QUERIES = {name: q for name, q in contract.queries().items() if name in NAMES}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in NAMES}
# Approximate answers; test_batch and test_summaries bound their error.
NO_SQL = {"distinct_parts_approx", "price_quantiles_approx", "stored_sketches"}


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(SQL) == NO_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def graded_sql(graded):
    return duck(graded)


@pytest.fixture(scope="module")
def small_sql(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, graded, graded_sql, name):
    assert differences(QUERIES[name](spark, graded), graded_sql, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_answer_from_shuffled_folders(spark, shuffled, small_sql, name):
    """Tables as folders of files, in another order: nothing may change."""
    assert differences(QUERIES[name](spark, shuffled), small_sql, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_not_empty_at_the_smallest_scale(spark, small, name):
    assert QUERIES[name](spark, small).limit(1).count() == 1


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory) -> str:
    root = tmp_path_factory.mktemp("empty")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", sorted(SQL))
def test_empty_tables(spark, empty, name):
    assert differences(QUERIES[name](spark, empty), duck(empty), SQL[name]) in (None, "both empty")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
