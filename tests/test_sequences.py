"""Patterns of events against regular expressions in Python."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.ordered import Limits
from tallyspark.operators.sequences import sequences

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("limits", [Limits(), Limits(rows_per_task=20)])
@pytest.mark.parametrize("seconds", [None, 25])
def test_matches_are_those_of_the_regular_expression(spark, limits, seconds):
    rng = random.Random(21)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), T0 + timedelta(seconds=10 * i + rng.randrange(10)), rng.choice("vvvcccpx")) for i in range(700)]
    rows += [(900, 2, T0 + timedelta(days=1), None)]
    df = spark.createDataFrame(rows, "id long, u int, ts timestamp_ntz, kind string").repartition(4)
    steps = [("v", 1, None), ("c", 1, 3), ("p", 1, 1)]
    found = sequences(df, ["u"], [F.asc("ts"), F.asc("id")], "kind", "ts", steps, seconds, limits)
    got = sorted(((r["u"], r["started_at"], r["ended_at"], r["counts"]) for r in found.collect()), key=repr)
    want = []
    for u in (1, 2, 3, None):
        own = sorted((r[2], r[0], r[3]) for r in rows if r[1] == u)
        for m in re.finditer("(v+)(c{1,3})p", "".join(k or "-" for _, _, k in own)):
            end, lead = own[m.end() - 1][0], own[m.end(1) - 1][0]
            if seconds is None or end - lead <= timedelta(seconds=seconds):
                want.append((u, own[m.start()][0], end, [len(m[1]), len(m[2]), 1]))
    assert got == sorted(want, key=repr) and len(want) > (5 if seconds is None else 0)


def test_patterns_that_could_overlap_are_refused(spark):
    df = spark.createDataFrame([(1, 1, T0, "v")], "id long, u int, ts timestamp_ntz, kind string")
    for steps in ([("v", 1, None)], [("v", 1, 2), ("c", 1, 1)], [("v", 1, None), ("c", 1, 2)], [("v", 1, None), ("c", 1, 1), ("v", 1, 1)]):
        with pytest.raises(ValueError):
            sequences(df, ["u"], [F.asc("ts")], "kind", "ts", steps)
