"""Hand-made rows for what the tables lack: nulls, bad text, ties, exact gaps."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import calendar, nested, text, values
from tallyspark.functions.exact import cents, mean, total
from tallyspark.functions.udfs import digit_sum, grouped_partials, trend_per_group
from tallyspark.operators import aggregates, cleaning, filters, joins, sessions, sets, sorting, windows
from tallyspark.session import shared_path
from tallyspark.sources.partitioned import read_by, write_by
from tallyspark.sources.tables import SCHEMAS, load
from tallyspark.sources.text import read_text


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def holes(spark):
    data = [(1, 2.0, "a"), (1, None, ""), (None, 5.0, None), (2, None, "b"), (None, None, "a")]
    return spark.createDataFrame(data, "k int, v double, s string")


def test_schemas_match_the_files(spark, small):
    for name in SCHEMAS:
        read = spark.read.parquet(f"{small}/{name}.parquet")
        assert load(spark, small, name).schema == read.schema, name


def test_bad_csv_rows_are_kept(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,amount,day\n1,2.50,2024-01-31\n2,many,2024-01-31\n3,1.00\n4,1.00,31.01.2024\n")
    got = read_text(spark, str(tmp_path), "csv", "id int, amount decimal(8,2), day date", "bad", header="true").cache()
    assert rows(got) == sorted(
        [
            (1, Decimal("2.50"), date(2024, 1, 31), None),
            (2, None, date(2024, 1, 31), "2,many,2024-01-31"),
            (3, Decimal("1.00"), None, "3,1.00"),
            (4, Decimal("1.00"), None, "4,1.00,31.01.2024"),
        ],
        key=repr,
    )


def test_bad_json_rows_are_kept(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"id": 1, "v": "x"}\n{"id": 2, \n{"id": "three"}\n{"v": "y"}\n')
    got = read_text(spark, str(tmp_path), "json", "id int, v string", "bad").cache()
    assert got.count() == 4
    assert got.where("bad is null").count() == 2
    assert got.where("id is null and bad is not null").count() == 2


def test_unknown_text_format(spark):
    with pytest.raises(ValueError):
        read_text(spark, "/nowhere", "xml", "a int", "bad")


def test_partitioned_round_trip_with_null_folder(spark, holes):
    path = shared_path(spark, "holes")
    write_by(holes, path, ["k"])
    assert rows(read_by(spark, path, "v double, s string, k int").select("k", "v", "s")) == rows(holes)


def test_null_safe_filter(holes):
    assert holes.where(filters.same("k", F.lit(None).cast("int"))).count() == 2
    assert holes.where(filters.same("k", F.lit(1))).count() == 2


def test_aggregates_skip_nulls(holes):
    got = aggregates.summary(holes, ["k"], {"t": total(cents("v")), "m": mean(cents("v")), "n": F.count("v")})
    assert rows(got) == sorted([(1, 2.0, 2.0, 1), (None, 5.0, 5.0, 1), (2, None, None, 0)], key=repr)


def test_rollup_tells_subtotals_from_null_keys(holes):
    got = aggregates.levels(holes, ["k"], "rollup", {"n": F.count(F.lit(1))}, merge={"n": F.sum})
    assert rows(got) == sorted([(1, 0, 2), (2, 0, 1), (None, 0, 2), (None, 1, 5)], key=repr)
    with pytest.raises(ValueError):
        aggregates.levels(holes, ["k"], "pile", {})


def test_unpivot_is_the_way_back_from_pivot(holes):
    counted = holes.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n")).where("s in ('a', 'b')")
    wide = aggregates.pivot(counted, ["k"], "s", ["a", "b"], F.sum("n"))
    back = aggregates.unpivot(wide, ["k"], ["a", "b"], "s", "n").where("n is not null")
    assert rows(back) == rows(counted)


def test_approximate_distinct_within_bound(spark, graded):
    lines = load(spark, graded, "lineitem")
    for column, rsd in (("l_partkey", 0.02), ("l_orderkey", 0.02)):
        exact = dict(rows(aggregates.distinct_counts(lines, ["l_returnflag"], column)))
        rough = dict(rows(aggregates.distinct_counts(lines, ["l_returnflag"], column, rsd)))
        assert exact.keys() == rough.keys()
        # Three standard deviations.
        assert all(abs(rough[k] - exact[k]) <= 3 * rsd * exact[k] for k in exact)


def test_approximate_quantiles_within_rank_bound(spark, graded):
    lines = load(spark, graded, "lineitem")
    got = aggregates.approx_quantiles(lines, ["l_returnflag"], "l_extendedprice", {"q": 0.9}, 1000).collect()
    for flag, q in got:
        group = lines.where(F.col("l_returnflag") == flag)
        n = group.count()
        below, upto = group.where(F.col("l_extendedprice") < q).count(), group.where(F.col("l_extendedprice") <= q).count()
        assert below - n / 1000 - 1 <= 0.9 * n <= upto + n / 1000 + 1


def test_exact_quantiles_interpolate(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 2.0, 10.0)] + [("b", 7.0), ("c", None)], "g string, v double")
    got = aggregates.exact_quantiles(df, ["g"], F.col("v"), {"median": 0.5, "p90": 0.9, "top": 1.0})
    assert [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows(got)] == [
        ("a", 2.0, 7.6, 10.0),
        ("b", 7.0, 7.0, 7.0),
    ]


def test_exact_quantiles_of_large_groups(spark):
    """Large enough for brackets: clumped values, ties at the wanted ranks, a hot group."""
    n = 300_000
    group = F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 3000 == 0, "tiny").otherwise("rest")
    value = F.when(F.col("id") % 7 < 3, F.lit(500.0)).otherwise((F.xxhash64("id") % 100_003).cast("double"))
    df = spark.range(n).select(group.alias("g"), value.alias("v")).repartition(6)
    wanted = {"least": 0.0, "low": 0.001, "q1": 0.25, "half": 0.5, "odd": 0.61803, "high": 0.9999, "most": 1.0}
    got = aggregates.exact_quantiles(df, ["g"], F.col("v"), wanted)
    want = df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(name) for name, p in wanted.items()])
    close = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert [close(r) for r in rows(got)] == [close(r) for r in rows(want)]


def test_ties_are_broken_by_the_last_column(spark):
    df = spark.createDataFrame([(1, 5, i) for i in (3, 1, 2)] + [(1, 9, 4)], "g int, v int, id int")
    order = [F.asc("v"), F.asc("id")]
    assert rows(windows.top_per(df, ["g"], order, 2)) == [(1, 5, 1, 1), (1, 5, 2, 2)]
    ranked = windows.ranks(df, ["g"], order, ["v"], 2).select("id", "row_number", "rank", "dense_rank", "ntile")
    assert rows(ranked) == [(1, 1, 1, 1, 1), (2, 2, 1, 1, 1), (3, 3, 1, 1, 2), (4, 4, 4, 2, 2)]
    assert [r.id for r in sorting.top(df, order, 3).collect()] == [1, 2, 3]


def test_previous_value_may_be_null(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "x"), (1, 3, None), (1, 4, None)], "g int, i int, v string")
    got = windows.change(df, ["g"], [F.asc("i")], ["v"]).select("i", "prev_v", "first_v")
    assert rows(got) == [(1, None, None), (2, None, None), (3, "x", None), (4, None, None)]


def test_outer_join_never_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "a int, x string")
    right = spark.createDataFrame([(1, "c"), (None, "d"), (2, "e")], "b int, y string")
    got = joins.outer(left, right, [("a", "b")], "full", {"x": "-"})
    assert rows(got) == sorted([(1, "a", 1, "c"), (None, "b", None, None), (None, "-", None, "d"), (None, "-", 2, "e")], key=repr)
    assert rows(joins.having_match(left, right, [("a", "b")])) == [(1, "a")]
    assert rows(joins.without_match(left, right, [("a", "b")])) == [(None, "b")]
    with pytest.raises(ValueError):
        joins.outer(left, right, [("a", "b")], "sideways")


def test_keys_of_one_name(spark, small):
    documents, labels = load(spark, small, "documents"), load(spark, small, "labels")
    same = [("doc_id", "doc_id")]
    labelled = joins.having_match(documents, labels, same).count()
    assert labelled == labels.count() and joins.without_match(documents, labels, same).count() == 200 - labelled
    assert joins.star(documents, [(labels, "doc_id", "doc_id")]).columns == [*documents.columns, "quality", "toxic"]


T0 = datetime(2024, 1, 1)


def test_interval_join_ends(spark):
    """Both ends of the interval belong to it, across cell borders."""
    left = spark.createDataFrame([(1, T0), (1, T0 + timedelta(hours=25))], "u int, at timestamp_ntz")
    offsets = [timedelta(0), timedelta(hours=1), timedelta(microseconds=-1), timedelta(hours=-24), timedelta(hours=-24, microseconds=-1)]
    right = spark.createDataFrame([(1, i, T0 + d) for i, d in enumerate(offsets)], "w int, i int, was timestamp_ntz")
    got = joins.within(left, right, ("u", "w"), ("at", "was"), 24 * 3600).select("at", "i")
    second = T0 + timedelta(hours=25)
    assert rows(got) == sorted([(T0, 0), (T0, 2), (T0, 3), (second, 1)], key=repr)


def test_interval_join_before_1970(spark):
    early = datetime(1969, 12, 31, 23, 59, 59)
    left = spark.createDataFrame([(1, datetime(1970, 1, 1, 0, 0, 1))], "u int, at timestamp_ntz")
    right = spark.createDataFrame([(1, early)], "w int, was timestamp_ntz")
    assert joins.within(left, right, ("u", "w"), ("at", "was"), 10).count() == 1
    assert joins.within(left, right, ("u", "w"), ("at", "was"), 1).count() == 0


def test_as_of_takes_equal_times_and_the_last_tie(spark):
    left = spark.createDataFrame([(1, 10, T0), (2, 11, T0), (None, 12, T0)], "u int, id int, ts timestamp_ntz")
    later = T0 + timedelta(microseconds=1)
    seen = [(1, 1, T0, "x"), (1, 2, T0, "y"), (2, 3, later, "z"), (None, 4, T0, "no key"), (2, 5, None, "no time")]
    right = spark.createDataFrame(seen, "u int, id int, ts timestamp_ntz, v string")
    got = joins.as_of(left, right, ["u"], "ts", "id", ["v"]).select("id", "v")
    assert rows(got) == [(10, "y"), (11, None), (12, None)]
    counted = joins.count_within(left, right, ["u"], "ts", 60, F.lit(1)).select("id", "n")
    assert rows(counted) == [(10, 2), (11, 0), (12, 0)]


def test_sessions_join_at_exactly_the_gap(spark):
    half = timedelta(minutes=30)
    data = [(1, T0), (1, T0 + half), (1, T0 + 2 * half + timedelta(microseconds=1)), (2, T0)]
    df = spark.createDataFrame(data, "u bigint, ts timestamp_ntz").withColumn("v", F.lit(1.0))
    got = sessions.sessions(df, "u", "ts", 1800, cents("v")).select("u", "session_start", "session_end", "events", "total")
    last = T0 + 2 * half + timedelta(microseconds=1)
    assert rows(got) == sorted([(1, T0, T0 + half, 2, 200), (1, last, last, 1, 100), (2, T0, T0, 1, 100)], key=repr)


def test_funnel_steps_must_follow_each_other(spark):
    data = [(1, 0, "buy"), (1, 1, "see"), (1, 2, "see"), (1, 2, "put"), (1, 3, "put"), (2, 1, "put"), (2, 1, "see"), (3, 1, "put")]
    df = spark.createDataFrame(data, "u int, t int, kind string")
    got = sessions.funnel(df, "u", "t", "kind", ["see", "put", "buy"])
    assert rows(got) == sorted([(1, 1, 2, None), (2, 1, None, None)], key=repr)


def test_set_operations_with_repeats_and_nulls(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    want = {
        "union": [1, 2, 3, None],
        "union_all": [1, 1, 1, 2, 3, None, None, None],
        "intersect": [1, None],
        "intersect_all": [1, None],
        "except": [2],
        "except_all": [1, 2, None],
    }
    for kind, expected in want.items():
        assert rows(sets.combine(a, b, kind)) == sorted([(x,) for x in expected], key=repr), kind
    with pytest.raises(ValueError):
        sets.combine(a, b, "minus")


def test_many_copies_are_dealt_out(spark):
    a = spark.range(50_000).select((F.col("id") % 4).alias("x"))
    b = spark.range(50_000).select(F.when(F.col("id") < 30_000, 1).otherwise(9).cast("bigint").alias("x"))
    got = sets._copies(a, b, lambda in_a, in_b: in_a - in_b, copies_per_task=700)
    assert rows(got.groupBy("x").count()) == [(0, 12_500), (2, 12_500), (3, 12_500)]
    spread = got.groupBy(F.spark_partition_id()).count().count()
    assert spread >= 4
    both = sets._copies(a, b, F.least, copies_per_task=700)
    assert rows(both.groupBy("x").count()) == [(1, 12_500)]


def test_dedupe_keeps_the_first_of_each(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "")], "id int, s string")
    assert rows(cleaning.dedupe(df, ["s"], [F.asc("id")])) == sorted([(1, "a"), (2, None), (5, "")], key=repr)


def test_quality_rules_count_nulls_as_broken(spark, holes):
    got = cleaning.row_rules(holes, {"v_small": F.col("v") < 3, "k_set": F.col("k").isNotNull()})
    assert rows(got) == [("k_set", 2), ("v_small", 4)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(cleaning.orphans(holes, parent, "k", "id", "lost")) == [("lost", 1)]
    assert rows(cleaning.repeated_keys(holes, ["k"], "twice")) == [("twice", 2)]
    assert rows(cleaning.orphans(parent, parent, "id", "id", "lost")) == [("lost", 0)]


def test_upsert(spark):
    schema = "k int, v string, version int"
    base = spark.createDataFrame([(1, "old", 1), (2, "kept", 5), (3, "same", 2)], schema)
    changes = spark.createDataFrame(
        [(1, "new", 2), (1, "newer", 3), (2, "late", 4), (3, "b", 2), (3, "c", 2), (4, "added", 1)], schema
    )
    got = cleaning.upsert(base, changes, ["k"], "version")
    assert rows(got) == [(1, "newer", 3), (2, "kept", 5), (3, "c", 2), (4, "added", 1)]


def test_text_functions(spark):
    df = spark.createDataFrame([("  A\t b\n\nC ", "HTTP://Ex.org:80/p?utm_source=x&y=1"), (None, "no url")], "s string, u string")
    got = df.select(
        text.clean("s"), text.host("u"), text.url_parameter("u", "y"), text.url_parameter("u", "z"), text.words("s")
    )
    assert [tuple(r) for r in got.collect()] == [("a b c", "ex.org", "1", "", ["", "a", "b", "c", ""]), (None, "", "", "", None)]
    assert rows(text.word_count(df, "s")) == [("a", 1), ("b", 1), ("c", 1)]


def test_growth_after_zero_is_null(spark):
    df = spark.createDataFrame([(datetime(2024, m, 1), v) for m, v in ((1, 0.0), (2, 4.0), (3, 6.0))], "period timestamp_ntz, v double")
    got = calendar.growth(df, "v", "month").select("v", "previous", "growth")
    assert rows(got) == sorted([(0.0, None, None), (4.0, 0.0, None), (6.0, 4.0, 0.5)], key=repr)
    with pytest.raises(ValueError):
        calendar.by_period(df, "period", "second", {})


def test_buckets(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (9.99,), (10.0,), (None,)], "v double")
    got = df.select(values.bucket("v", [0, 10]), values.equal_width("v", 0, 10, 5))
    assert [tuple(r) for r in got.collect()] == [(0, 0), (1, 1), (1, 5), (2, 6), (None, None)]


def test_json_of_the_wrong_shape_is_null(spark):
    df = spark.createDataFrame([('{"k": 3}',), ('{"k": "x"}',), ("{torn",), (None,), ("{}",)], "p string")
    got = df.select(
        nested.json_field("p", "$.k", "bigint"), nested.json_struct("p", "k bigint")["k"], nested.json_variant("p", "$.k", "bigint")
    )
    assert [tuple(r) for r in got.collect()] == [(3, 3, 3)] + [(None, None, None)] * 4


def test_cosine_of_a_zero_vector_is_null(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [3.0, 4.0])], "id int, v array<float>")
    got = df.select("id", F.round(nested.cosine(F.col("v"), [1.0, 0.0]), 9))
    assert rows(got) == [(1, 1.0), (2, None), (3, 0.6)]


def test_count_map(spark, holes):
    got = nested.count_map(holes, ["k"], "s", ["a", "b"]).collect()
    assert {r.k: r.counts for r in got} == {1: {"a": 1, "b": 0}, None: {"a": 1, "b": 0}, 2: {"a": 0, "b": 1}}


def test_python_functions_on_nulls_and_zero(spark):
    df = spark.createDataFrame([(0, 5), (0, 7), (None, 1)], "k bigint, v bigint")
    assert rows(grouped_partials(df, ["k"], "v")) == sorted([(0, 2, 12, 7), (None, 1, 1, 1)], key=repr)
    assert rows(spark.createDataFrame([(0,), (-909,), (10**15 + 7,)], "n bigint").select(digit_sum("n"))) == [(0,), (18,), (8,)]
    one = trend_per_group(df.where("k = 0"), "k", F.lit(1), F.col("v"))
    assert rows(one) == [(0, 1, None)]
    line = spark.createDataFrame([(1, 0, 1), (1, 1, 3), (1, 3, None), (1, None, 9), (1, 2, 5)], "k bigint, x int, v int")
    assert rows(trend_per_group(line, "k", F.col("x"), F.col("v"))) == [(1, 3, 2.0)]
