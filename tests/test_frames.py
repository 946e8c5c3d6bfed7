"""Moving frames, values n rows apart and overlap joins against plain Python, hot keys cut in slices."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.frames import row_frames, shifted, time_extremes
from tallyspark.operators.ordered import Limits
from tallyspark.operators.overlaps import overlapping

T0 = datetime(2024, 1, 1)
TIGHT = Limits(rows_per_task=16)  # every larger group is cut


@pytest.fixture(scope="module")
def data(spark):
    """Half of all rows have key 0; some values, keys and times are null, times tie."""
    rng = random.Random(11)
    rows = [
        (i, rng.choice([0, 0, 0, 1, 2, 3, None]), T0 + timedelta(seconds=rng.randrange(4000)), rng.choice([None, *range(50)])) for i in range(400)
    ]
    return rows, spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz, v int").repartition(5)


def groups(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2] or datetime.min, r[0])):
        out.setdefault(r[1], []).append(r)
    return out.values()



def order():
    return [F.asc("ts"), F.asc("id")]


@pytest.mark.parametrize("limits", [Limits(), TIGHT])
@pytest.mark.parametrize("before,after", [(0, 0), (3, 0), (0, 2), (5, 7), (40, 3)])
def test_row_frames(data, limits, before, after):
    rows, df = data

    def make(w):
        frame = w.rowsBetween(-before, after)
        return {"low": F.min("v").over(frame), "high": F.max("v").over(frame), "mid": F.percentile("v", 0.5).over(frame), "n": F.count(F.lit(1)).over(frame)}

    got = {r["id"]: tuple(r)[4:] for r in row_frames(df, ["k"], order(), before, after, make, limits).collect()}
    want = {}
    for group in groups(rows):
        for i, r in enumerate(group):
            frame = group[max(0, i - before) : i + after + 1]
            known = [x[3] for x in frame if x[3] is not None]
            want[r[0]] = (min(known, default=None), max(known, default=None), median(known) if known else None, len(frame))
    assert got == want


@pytest.mark.parametrize("limits", [Limits(), TIGHT])
@pytest.mark.parametrize("offset", [1, 4, 33])
def test_shifted(data, limits, offset):
    rows, df = data
    got = {r["id"]: (r["prev_v"], r["next_v"]) for r in shifted(df, ["k"], order(), ["v"], offset, limits).collect()}
    want = {}
    for group in groups(rows):
        for i, r in enumerate(group):
            want[r[0]] = (group[i - offset][3] if i >= offset else None, group[i + offset][3] if i + offset < len(group) else None)
    assert got == want


@pytest.mark.parametrize("limits", [Limits(), TIGHT])
@pytest.mark.parametrize("seconds", [1, 60, 700, 10_000])
def test_time_extremes(spark, data, limits, seconds):
    rows = data[0] + [(1000 + i, k, None, v) for i, (k, v) in enumerate([(0, 5), (0, 90), (7, None), (None, 3)])]
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp_ntz, v int").repartition(4)
    found = time_extremes(df, ["k"], "ts", seconds, {"low": ("min", "v"), "high": ("max", "v")}, limits)
    got = {r["id"]: (r["low"], r["high"]) for r in found.collect()}
    want = {}
    for a in rows:
        frame = [b[3] for b in rows if b[1] == a[1] and b[3] is not None and (
            b[2] is None if a[2] is None else b[2] is not None and a[2] - timedelta(seconds=seconds) <= b[2] <= a[2])]
        want[a[0]] = (min(frame, default=None), max(frame, default=None))
    assert got == want and found.columns == [*df.columns, "low", "high"]


def spans(rng, n, base):
    rows = []
    for i in range(n):
        first = T0 + timedelta(microseconds=rng.randrange(10**10))
        long = rng.choice([0, 1, 10**5, 10**6, 3 * 10**7, 10**9, -5])
        rows.append((base + i, rng.choice([1, 1, 1, 2, None]), first, first + timedelta(microseconds=long)))
    rows += [(base + n, 1, T0 - timedelta(days=900), T0 + timedelta(days=900)), (base + n + 1, 1, None, T0), (base + n + 2, 1, T0, None)]
    return rows + [(base + n + 3, 2, datetime(1969, 12, 31, 23), datetime(1970, 1, 1, 1))]


def test_overlaps(spark):
    rng = random.Random(12)
    a, b = spans(rng, 150, 0), spans(rng, 120, 1000)
    # Spans that touch, and one long span on either side of all others.
    b += [(5000 + i, r[1], r[3], r[3] + timedelta(seconds=2)) for i, r in enumerate(a[:40]) if r[3]]
    left = spark.createDataFrame(a, "a long, ka int, a0 timestamp_ntz, a1 timestamp_ntz").repartition(3)
    right = spark.createDataFrame(b, "b long, kb int, b0 timestamp_ntz, b1 timestamp_ntz").repartition(3)
    found = overlapping(left, right, ("ka", "kb"), (("a0", "a1"), ("b0", "b1")))
    assert found.columns == [*left.columns, *right.columns]
    got = sorted((r["a"], r["b"]) for r in found.collect())
    sound = lambda r: None not in r and r[2] < r[3]
    want = sorted((x[0], y[0]) for x in filter(sound, a) for y in filter(sound, b) if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    assert got == want and len(got) > 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert overlapping(left.where("false"), right, ("ka", "kb"), (("a0", "a1"), ("b0", "b1"))).count() == 0
