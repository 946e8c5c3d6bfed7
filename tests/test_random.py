"""Random cases against plain Python: each key is a case, one job runs all."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import joins, sessions, windows
from tallyspark.operators.ordered import Limits

T0 = datetime(2024, 3, 1)
CASES = 60
# None: everything plain. The other cuts every case with more than four rows.
LIMITS = [Limits(), Limits(rows_per_task=4)]


@pytest.fixture(scope="module")
def cases():
    """key -> rows (id, seconds, kind, value); crowded times, empty cases too."""
    rng = random.Random(20240301)
    out = {}
    for key in range(CASES):
        span = rng.choice([3, 20, 200])
        out[key] = [
            (key * 1000 + i, rng.randrange(span), rng.choice("abc"), rng.choice([None, 1, 2, 7]))
            for i in range(rng.choice([1, 2, 5, 12, 30]))
        ]
    return out


@pytest.fixture(scope="module")
def events(spark, cases):
    data = [(k, i, T0 + timedelta(seconds=s), kind, v) for k, rows in cases.items() for i, s, kind, v in rows]
    random.Random(1).shuffle(data)
    schema = "k bigint, id bigint, ts timestamp_ntz, kind string, v bigint"
    return spark.createDataFrame(data, schema).repartition(4).cache()


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("id", *columns).collect()}


@pytest.mark.parametrize("limits", LIMITS)
def test_moving(events, cases, limits):
    got = by_id(windows.moving(events, ["k"], "ts", 5, {"n": F.lit(1), "t": F.col("v")}, limits), "n", "t")
    want = {}
    for rows in cases.values():
        for i, s, _, _ in rows:
            near = [r for r in rows if s - 5 <= r[1] <= s]
            want[i] = (len(near), sum(r[3] or 0 for r in near))
    assert got == want


@pytest.mark.parametrize("limits", LIMITS)
def test_as_of(events, cases, limits):
    left = events.where("kind = 'a'").select("k", "id", "ts")
    right = events.where("kind = 'b'").select("k", "id", "ts", F.col("id").alias("hit"))
    got = by_id(joins.as_of(left, right, ["k"], "ts", "id", ["hit"], limits), "hit")
    want = {}
    for rows in cases.values():
        for i, s, kind, _ in rows:
            if kind == "a":
                before = [(r[1], r[0]) for r in rows if r[2] == "b" and r[1] <= s]
                want[i] = (max(before)[1] if before else None,)
    assert got == want


@pytest.mark.parametrize("limits", LIMITS)
def test_count_within(events, cases, limits):
    left = events.where("kind = 'a'").select("k", "id", "ts")
    right = events.where("kind <> 'a'").select("k", "ts", "v")
    got = by_id(joins.count_within(left, right, ["k"], "ts", 7, F.col("v"), limits), "n", "total")
    want = {}
    for rows in cases.values():
        for i, s, kind, _ in rows:
            if kind == "a":
                near = [r for r in rows if r[2] != "a" and s - 7 <= r[1] <= s]
                want[i] = (len(near), sum(r[3] or 0 for r in near))
    assert got == want


def test_within_pairs(events, cases):
    left = events.where("kind = 'a'").select("k", F.col("id").alias("l"), F.col("ts").alias("at"))
    right = events.where("kind = 'b'").select(F.col("k").alias("w"), F.col("id").alias("r"), F.col("ts").alias("was"))
    got = sorted((x.l, x.r) for x in joins.within(left, right, ("k", "w"), ("at", "was"), 6).collect())
    want = sorted(
        (a[0], b[0])
        for rows in cases.values()
        for a in rows
        for b in rows
        if a[2] == "a" and b[2] == "b" and 0 <= a[1] - b[1] <= 6
    )
    assert got == want


@pytest.mark.parametrize("limits", LIMITS)
def test_sessions(events, cases, limits):
    got = sorted(
        (r.k, (r.session_start - T0).seconds, (r.session_end - T0).seconds, r.events)
        for r in sessions.sessions(events, "k", "ts", 4, F.col("v"), limits).collect()
    )
    want = []
    for key, rows in cases.items():
        run = []
        for s in sorted(r[1] for r in rows):
            if run and s - run[-1] > 4:
                want.append((key, run[0], run[-1], len(run)))
                run = []
            run.append(s)
        want.append((key, run[0], run[-1], len(run)))
    assert got == sorted(want)


@pytest.mark.parametrize("limits", LIMITS)
def test_funnel(events, cases, limits):
    got = {r.k: tuple(r)[1:] for r in sessions.funnel(events, "k", "ts", "kind", ["a", "b", "c"], limits).collect()}
    want = {}
    for key, rows in cases.items():
        since, steps = -1, []
        for kind in "abc":
            later = [r[1] for r in rows if r[2] == kind and r[1] > since] if len(steps) == "abc".index(kind) else []
            if later:
                since = min(later)
                steps.append(since)
        if steps:
            times = [T0 + timedelta(seconds=s) for s in steps]
            want[key] = tuple(times + [None] * (3 - len(times)))
    assert got == want


@pytest.mark.parametrize("limits", LIMITS)
def test_ranks(events, cases, limits):
    order = [F.asc("ts"), F.asc("id")]
    got = by_id(windows.ranks(events, ["k"], order, ["ts"], 3, limits), "row_number", "rank", "dense_rank", "ntile")
    want = {}
    for rows in cases.values():
        ordered = sorted(rows, key=lambda r: (r[1], r[0]))
        times = [r[1] for r in ordered]
        small, bigger = divmod(len(rows), 3)
        tiles = [t + 1 for t in range(3) for _ in range(small + (t < bigger))]
        for n, r in enumerate(ordered):
            want[r[0]] = (n + 1, times.index(r[1]) + 1, len({t for t in times if t <= r[1]}), tiles[n])
    assert got == want
