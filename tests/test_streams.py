"""Streams fed in steps: late rows, repeats, restarts on one checkpoint."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.streaming.joins import enrich, match
from tallyspark.sources.merged import Merged
from tallyspark.streaming.run import finished, run_available, run_merged
from tallyspark.streaming.state import latest_state, running_state
from tallyspark.streaming.timed import baskets
from tallyspark.streaming.windows import stream_dedupe, stream_sessions, windowed

T0 = datetime(2024, 1, 1)
SCHEMA = "id bigint, u bigint, ts timestamp_ntz"


def aggs():
    return {"n": F.count(F.lit(1))}


class Feed:
    """A folder that a stream watches; each ``add`` is one more file."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        (root / "in").mkdir(parents=True)

    def add(self, *rows):
        data = [(i, u, T0 + timedelta(minutes=m)) for i, u, m in rows]
        path = str(self.root / "in" / f"{self.n}")
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(path)
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(f"{self.root}/in/*")

    def run(self, stream):
        return run_available(stream, str(self.root / "out"), str(self.root / "state"))

    def result(self):
        return self.spark.read.parquet(str(self.root / "out"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_late_rows_are_dropped_and_counted(feed):
    def stream():
        return windowed(feed.stream(), "ts", "1 hour", None, "10 minutes", [], aggs())

    feed.add((1, 1, 1), (2, 1, 120))
    feed.run(stream())
    assert rows(feed.result().select("window_start", "n")) == [(T0, 1)]
    feed.add((3, 1, 2), (4, 1, 121), (5, 1, 300))
    reports = feed.run(stream())
    dropped = sum(op["numRowsDroppedByWatermark"] for r in reports for op in r["stateOperators"])
    assert dropped == 1
    assert rows(feed.result().select("window_start", "n")) == sorted([(T0, 1), (T0 + timedelta(hours=2), 2)], key=repr)


def test_sliding_windows_count_a_row_once_per_window(feed):
    feed.add((1, 1, 50), (2, 1, 600))
    feed.run(windowed(feed.stream(), "ts", "1 hour", "30 minutes", "0 seconds", [], aggs()))
    got = rows(feed.result().select("window_start", "n"))
    assert got == sorted([(T0, 1), (T0 + timedelta(minutes=30), 1)], key=repr)


def test_sessions_grow_across_runs(feed):
    def stream():
        return stream_sessions(feed.stream(), "ts", "30 minutes", "1 hour", ["u"], aggs())

    feed.add((1, 1, 0), (2, 1, 30), (3, 2, 0))
    feed.run(stream())
    feed.add((4, 1, 55), (5, 1, 86), (6, 9, 500))
    feed.run(stream())
    got = rows(feed.result().select("u", "session_start", "session_end", "n"))
    at = lambda m: T0 + timedelta(minutes=m)
    assert got == sorted([(1, at(0), at(85), 3), (1, at(86), at(116), 1), (2, at(0), at(30), 1)], key=repr)


def test_repeats_inside_the_delay_are_removed(feed):
    def stream():
        once = stream_dedupe(feed.stream(), "ts", "10 minutes", ["id"])
        return once.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"))

    feed.add((1, 1, 0), (1, 1, 5), (2, 1, 1))
    feed.run(stream())
    feed.add((1, 1, 9), (3, 1, 200))
    feed.run(stream())
    assert sorted(r.id for r in feed.result().collect()) == [1, 2, 3]
    # Far outside the delay the key is new again.
    feed.add((1, 1, 300))
    feed.run(stream())
    assert sorted(r.id for r in feed.result().collect()) == [1, 1, 2, 3]


def test_a_finished_run_adds_nothing_when_repeated(feed):
    feed.add((1, 1, 0))
    for _ in range(2):
        feed.run(feed.stream())
    assert feed.result().count() == 1


def test_stream_with_table(spark, feed):
    dim = spark.createDataFrame([(1, "one")], "k bigint, name string")
    feed.add((1, 1, 0), (2, 2, 0))
    feed.run(enrich(feed.stream(), dim, ("u", "k")).select("id", "name"))
    assert rows(feed.result()) == sorted([(1, "one"), (2, None)], key=repr)


def test_two_streams_meet_across_runs(feed):
    def stream():
        buys = feed.stream().where("id >= 100").select(F.col("id").alias("buy"), "u", F.col("ts").alias("bought"))
        looks = feed.stream().where("id < 100").select(F.col("id").alias("look"), F.col("u").alias("w"), F.col("ts").alias("looked"))
        return match(buys, looks, ("u", "w"), ("bought", "looked"), 3600, "2 hours").select("buy", "look")

    feed.add((1, 1, 0), (2, 1, 10), (3, 2, 10), (100, 1, 5))
    feed.run(stream())
    assert rows(feed.result()) == [(100, 1)]
    feed.add((101, 1, 60), (102, 1, 70), (103, 1, 71), (4, 1, 60))
    feed.run(stream())
    assert rows(feed.result()) == sorted([(100, 1), (101, 1), (101, 2), (101, 4), (102, 2), (102, 4), (103, 4)], key=repr)


def test_state_goes_on_after_a_restart(feed):
    def stream():
        return running_state(feed.stream(), "u", F.col("id"))

    feed.add(*[(i, 7, i) for i in range(1, 21)], (5, 8, 0))
    feed.run(stream())
    assert rows(latest_state(feed.result())) == [(7, 20, 210, 20), (8, 1, 5, 5)]
    feed.add((1000, 7, 0), (-4, 8, 1))
    feed.run(stream())
    assert rows(latest_state(feed.result())) == [(7, 21, 1210, 1000), (8, 2, 1, 5)]


def test_a_kept_result_goes_on(feed):
    def result(kept):
        found = stream_sessions(feed.stream(), "ts", "30 minutes", "10 minutes", ["u"], aggs())
        return rows(finished(found.select("u", "session_start", "n"), "kept", kept).select("u", "n"))

    kept = str(feed.root / "kept")
    feed.add((1, 1, 0), (2, 1, 10), (3, 2, 200))
    assert result(kept) == [(1, 2)]  # user 2 is still open
    feed.add((4, 2, 210), (5, 3, 900))
    assert result(kept) == [(1, 2), (2, 2)]
    assert result(kept) == [(1, 2), (2, 2)]


# ---- baskets, closed by purchases and by timers ----


def basket_stream(feed):
    kind = F.element_at(F.array(F.lit("click"), F.lit("purchase"), F.lit("view")), (F.col("id") % 3 + 1).cast("int"))
    return baskets(feed.stream().withColumn("kind", kind), "u", "ts", "kind", "10 minutes", 30)


def minutes_of(found):
    at = lambda t: int((t - T0).total_seconds() // 60)
    return sorted((r["key"], at(r["opened_at"]), at(r["closed_at"]), r["clicks"], r["bought"]) for r in found.collect())


CLICK, BUY, VIEW = 0, 1, 2


def test_a_timer_closes_a_basket_without_a_further_row(feed):
    feed.add((CLICK, 1, 0), (CLICK, 1, 5), (VIEW, 1, 6), (CLICK, 2, 1), (BUY, 2, 3), (BUY, 2, 4))
    feed.run(basket_stream(feed))
    assert not (feed.root / "out").exists() or minutes_of(feed.result()) == []
    feed.add((CLICK, 3, 60))  # another user's row moves the time to 50: 35 has passed
    feed.run(basket_stream(feed))
    assert minutes_of(feed.result()) == [(1, 0, 35, 2, False), (2, 1, 3, 1, True)]
    feed.add((BUY, 1, 30), (BUY, 3, 70))  # the first is behind the watermark
    progress = feed.run(basket_stream(feed))
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) == 1
    feed.add((VIEW, 9, 500), (CLICK, 9, 500))
    feed.run(basket_stream(feed))
    assert minutes_of(feed.result()) == [(1, 0, 35, 2, False), (2, 1, 3, 1, True), (3, 60, 70, 1, True)]


def plain_baskets(rows, idle, passed):
    out, by = [], {}
    for kind, u, m in rows:
        by.setdefault(u, {}).setdefault(m, [0, 0])
        if kind % 3 < 2:
            by[u][m][kind % 3] += 1
    for u, minutes in by.items():
        basket = None
        for m in sorted(minutes):
            clicks, buys = minutes[m]
            if basket and m > basket[1] + idle:
                out.append((u, basket[0], basket[1] + idle, basket[2], False))
                basket = None
            if clicks:
                basket = (basket[0], m, basket[2] + clicks) if basket else (m, m, clicks)
            if buys and basket:
                out.append((u, basket[0], m, basket[2], True))
                basket = None
        if basket:
            out.append((u, basket[0], basket[1] + idle, basket[2], False))
    return sorted(b for b in out if b[2] <= passed)


def test_baskets_do_not_depend_on_the_batches(feed):
    rng = random.Random(3)
    rows = [(rng.randrange(3), rng.randrange(4), m) for m in range(0, 600, 2) if rng.random() < 0.8]
    for at in range(0, len(rows), 60):
        part = rows[at : at + 60]
        rng.shuffle(part)
        # Within the delay, so rows of neighbouring batches may change places.
        feed.add(*part[::2])
        feed.add(*part[1::2])
        feed.run(basket_stream(feed))
    last = max(m for k, _, m in rows if k < 2)
    assert minutes_of(feed.result()) == plain_baskets(rows, 30, last - 10)


# ---- purchases without a click ----


def test_outer_matches_come_out_when_the_watermark_passes(feed):
    def stream():
        source = feed.stream()
        left = source.where("id < 100").select(F.col("id").alias("l"), F.col("u").alias("lu"), F.col("ts").alias("lt"))
        right = source.where("id >= 100").select(F.col("id").alias("r"), F.col("u").alias("ru"), F.col("ts").alias("rt"))
        return match(left, right, ("lu", "ru"), ("lt", "rt"), 3600, "10 minutes", "left_outer").select("l", "r")

    feed.add((1, 1, 10), (2, 2, 10), (101, 1, 5), (3, 3, 200), (102, 3, 100), (102, 9, 200))
    feed.run(stream())
    assert rows(feed.result()) == sorted([(1, 101), (2, None)], key=repr)  # 3 is still open at 190
    feed.add((103, 3, 195), (104, 9, 300), (4, 9, 320))
    feed.run(stream())
    assert rows(feed.result()) == sorted([(1, 101), (2, None), (3, 103), (4, 104)], key=repr)


# ---- tables merged by parts ----


def merged(spark, tmp_path, parts=4):
    return Merged(str(tmp_path / "table"), "k long, v string, n int", ["k"], "n", parts)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string, n int")


def test_merging_again_changes_nothing(spark, tmp_path):
    table = merged(spark, tmp_path)
    assert table.read(spark).count() == 0
    assert table.merge(changes(spark, (1, "a", 1), (2, "b", 1), (2, "c", 2), (None, "z", 1)), 0)
    before = rows(table.read(spark))
    assert before == rows(changes(spark, (1, "a", 1), (2, "c", 2), (None, "z", 1)))
    assert not table.merge(changes(spark, (1, "x", 9)), 0) and rows(table.read(spark)) == before
    assert table.merge(changes(spark, (1, "old", 0), (2, "d", 2), (3, "e", 1)), 5)
    after = rows(changes(spark, (1, "a", 1), (2, "d", 2), (3, "e", 1), (None, "z", 1)))
    assert rows(table.read(spark)) == after
    assert table.merge(changes(spark), 6) and rows(table.read(spark)) == after
    table.tidy(spark)
    assert rows(table.read(spark)) == after and not table.merge(changes(spark, (1, "x", 9)), 6)


def test_a_batch_that_failed_before_its_commit_is_not_seen(spark, tmp_path):
    table = merged(spark, tmp_path)
    table.merge(changes(spark, (1, "a", 1), (2, "b", 1)), 0)
    seen = rows(table.read(spark))
    # As if the driver had died between the rows and the commit: the rows are there, the commit isn't.
    table.merge(changes(spark, (1, "half", 2)), 1)
    for f in (tmp_path / "table" / "published" / "batch=1").iterdir():
        f.unlink()
    assert rows(table.read(spark)) == seen
    assert table.merge(changes(spark, (1, "whole", 2)), 1)
    assert rows(table.read(spark)) == rows(changes(spark, (1, "whole", 2), (2, "b", 1)))


def test_untouched_parts_are_not_read(spark, tmp_path):
    table = merged(spark, tmp_path, parts=8)
    table.merge(changes(spark, *[(i, "a", 1) for i in range(100)]), 0)
    table.merge(changes(spark, (7, "b", 2)), 1)
    _, places = table._published(spark)
    assert sorted(places) == list(range(8)) and sorted(places.values()) == [0] * 7 + [1]
    written = spark.read.parquet(f"{table.root}/data/batch=1")
    assert written.select("part").distinct().count() == 1 and table.read(spark).count() == 100
    files = {f.rpartition("part=")[2].split("/")[0] for f in table._read(spark, {p: b for p, b in places.items() if b == 1}).inputFiles()}
    assert len(files) == 1


def test_live_windows_go_on_after_a_restart(feed, spark, tmp_path):
    table = Merged(str(tmp_path / "live"), "window_start timestamp_ntz, n long", ["window_start"], "n", 3)

    def step():
        run_merged(windowed(feed.stream(), "ts", "1 hour", None, "10 minutes", [], aggs()), table, str(tmp_path / "live-state"))
        return sorted((int((r["window_start"] - T0).total_seconds() // 3600), r["n"]) for r in table.read(spark).collect())

    feed.add((1, 1, 1), (2, 1, 59), (3, 1, 61))
    assert step() == [(0, 2), (1, 1)]
    assert step() == [(0, 2), (1, 1)]
    feed.add((4, 1, 62), (5, 1, 300), (6, 1, 58))
    assert step() == [(0, 3), (1, 2), (5, 1)]
    feed.add((7, 1, 5), (8, 1, 301))  # the first is late
    assert step() == [(0, 3), (1, 2), (5, 2)]
