"""The data source of labelled lines: round trips, bad rows, ranges, restarts."""

from __future__ import annotations

from datetime import datetime

import pytest

from tallyspark.sources.labelled import register

SCHEMA = "id long, name string, n int, x double, ok boolean, at timestamp_ntz"
ROWS = [
    (1, "a\tb\\c\nd\re:f", 5, 0.1, True, datetime(2024, 1, 2, 3, 4, 5, 678)),
    (2, "", None, float("inf"), False, None), (3, None, -7, 1e-300, None, datetime(1969, 12, 31)), (None,) * 6, (1 << 62, "é x", 0, -0.0, True, None),
]


@pytest.fixture
def source(spark):
    return register(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("split", [1, 7, 50, 1 << 20])
def test_round_trip_in_ranges_of_any_size(source, tmp_path, split):
    df = source.createDataFrame(ROWS * 3, SCHEMA).repartition(3)
    folder = f"{tmp_path}/t"
    df.write.format("labelled").mode("append").save(folder)
    back = lambda: source.read.format("labelled").option("splitBytes", split).schema(SCHEMA).load(folder)
    assert rows(back()) == rows(df)
    df.limit(2).write.format("labelled").mode("overwrite").save(f"file://{folder}")
    assert back().count() == 2
    df.where("false").write.format("labelled").mode("overwrite").save(folder)
    assert back().count() == 0


def test_bad_rows_are_kept(source, tmp_path):
    lines = ["id:1\tname:a", "id:x\tname:b", "no label", "id:99999999999999999999", "name:a\tname:b", "id:2\tname:bad \\q", "other:7\tid:3", ""]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f").write_text("\n".join(lines))
    (tmp_path / "t" / ".hidden").write_text("id:8")
    read = source.read.format("labelled")
    got = rows(read.schema("id long, name string, _bad string").load(f"{tmp_path}/t"))
    good = [(1, "a", None), (3, None, None)]
    assert got == sorted(good + [(None, None, lines[i]) for i in (1, 2, 3, 4, 5)], key=repr)
    assert rows(read.schema("name string, id long").load(f"{tmp_path}/t")) == sorted([("a", 1), (None, 3)], key=repr)


def test_a_stream_goes_on_after_a_restart(source, tmp_path):
    def add(*ids):
        source.createDataFrame([(i, f"v{i}") for i in ids], "id long, name string").coalesce(1).write.format("labelled").mode("append").save(f"{tmp_path}/in")

    def run():
        stream = source.readStream.format("labelled").schema("id long, name string").load(f"{tmp_path}/in")
        query = stream.writeStream.format("labelled").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        return sorted(r["id"] for r in source.read.format("labelled").schema("id long").load(f"{tmp_path}/out").collect())

    add(1, 2)
    add(3)
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]
    add(4, 5)
    assert run() == [1, 2, 3, 4, 5]
