"""Heavy hitters, stored sketches, and lines of texts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.functions.udfs import TextLines
from tallyspark.operators.heavy import heavy_hitters, trimmed
from tallyspark.operators.sketches import distinct_in_all, distinct_in_any, quantiles_of, sketched
from tallyspark.session import pinned


@pytest.mark.parametrize("one_in", [1, 2, 5, 40, 1000])
def test_heavy_hitters_are_exact(spark, one_in):
    rng = random.Random(one_in)
    rows = [(rng.choice([None, "a", "a", "b", f"x{rng.randrange(3000)}"]), rng.randrange(2)) for _ in range(4000)]
    got = {tuple(r) for r in heavy_hitters(spark.createDataFrame(rows, "w string, k int").repartition(7), ["w", "k"], one_in).collect()}
    assert got == {(*v, n) for v, n in Counter(rows).items() if n * one_in > len(rows)}


def test_a_share_just_met_is_not_more(spark):
    df = spark.createDataFrame([("a",)] * 20 + [("b",)] * 21 + [(f"c{i}",) for i in range(59)], "w string").repartition(4)
    assert [tuple(r) for r in heavy_hitters(df, ["w"], 5).collect()] == [("b", 21)]
    assert heavy_hitters(df.where("false"), ["w"], 5).count() == 0


def test_counters_are_bounded_and_lose_little():
    rng = random.Random(6)
    for most in (1, 3, 10):
        counts, seen, total = {}, Counter(), 0
        for _ in range(300):
            batch = Counter(int(rng.paretovariate(0.8)) for _ in range(20))
            seen += batch
            total += 20
            counts = trimmed(dict(Counter(counts) + batch), most)
            assert len(counts) <= most
            for value, n in seen.items():
                assert 0 <= n - counts.get(value, 0) <= total / (most + 1)


@pytest.fixture(scope="module")
def stored(spark):
    rng = np.random.default_rng(7)
    days = rng.integers(0, 10, 60_000)
    users = rng.integers(0, 20_000, 60_000) + 3_000 * days
    values = rng.lognormal(3, 1, 60_000)
    rows = [(int(d), int(u) if u % 50 else None, float(v)) for d, u, v in zip(days, users, values)]
    df = spark.createDataFrame(rows, "day int, user long, value double").repartition(6)
    return rows, pinned(sketched(df, [F.col("day")], {"users": F.col("user")}, {"value": F.col("value")}), "sketches")


def test_sketches_of_any_days(stored):
    rows, sketches = stored
    assert sketches.count() == 10
    every = {u for _, u, _ in rows if u is not None}
    assert abs(distinct_in_any(sketches, "users").first()[0] / len(every) - 1) < 0.05
    by_half = distinct_in_any(sketches, "users", [(F.col("day") < 5).alias("early")]).collect()
    for r in by_half:
        want = {u for d, u, _ in rows if u is not None and (d < 5) == r["early"]}
        assert abs(r["users"] / len(want) - 1) < 0.05
    got = distinct_in_all(sketches, "users", {"a": F.col("day") < 5, "b": F.col("day").between(3, 7)}).first()
    a, b = ({u for d, u, _ in rows if u is not None and d in days} for days in (range(5), range(3, 8)))
    assert abs(got["a"] / len(a) - 1) < 0.05 and abs(got["b"] / len(b) - 1) < 0.05
    assert abs(got["all"] - len(a & b)) < 0.05 * len(a | b)


def test_quantiles_of_any_days(stored):
    rows, sketches = stored
    ranks = [0.01, 0.25, 0.5, 0.9, 0.99]
    for days in (range(10), [4]):
        got = quantiles_of(sketches.where(F.col("day").isin(list(days))), "value", ranks).first()["value"]
        values = np.sort([v for d, _, v in rows if d in days])
        for rank, found in zip(ranks, got):
            assert abs(np.searchsorted(values, found) / len(values) - rank) < 0.02


def test_questions_do_not_read_the_rows_again(stored):
    plan = quantiles_of(stored[1], "value", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "value_kll" in plan and "users_theta" not in plan


def test_small_sets_are_exact(spark):
    df = spark.createDataFrame([(1, i % 7, 1.0) for i in range(50)] + [(2, i % 5, 2.0) for i in range(50)] + [(3, None, None)], "day int, user int, value double")
    sketches = sketched(df, [F.col("day")], {"u": F.col("user")}, {})
    assert tuple(distinct_in_all(sketches, "u", {"a": F.col("day") == 1, "b": F.col("day") > 1}).first()) == (7, 5, 5)


def test_lines(spark):
    texts = [None, "", "  ", "a b\n\n \nc", "x y\x1cz  w\t\x0bq\r\n\tlast", "\t"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in TextLines(rows.asTable()).collect())
    want = [
        (i, number, len(line), len(re.findall(r"[^ \t\n\f\r]+", line)))
        for i, t in enumerate(texts) for number, line in enumerate((t or "").split("\n"), 1) if line.strip(" ")
    ]
    assert got == want and (4, 1, 12, 3) in got
