"""Scans, filters, joins, aggregates and set operations on the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.exact import amount, cents, gross, hundredths, mean, net, total
from tallyspark.operators import aggregates, filters, joins, sets, sorting
from tallyspark.plans.catalogue import Catalogue
from tallyspark.session import shared_path
from tallyspark.sources.partitioned import read_by, write_by
from tallyspark.sources.tables import SCHEMAS, ask, load
from tallyspark.sources.text import read_text, write_text

CATALOGUE = Catalogue()
query = CATALOGUE.query


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {len(ddl.split(','))} AS n_columns FROM {name}"
        for name, ddl in SCHEMAS.items()
    )
)
def table_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Typed scan of every table; the counts come from the file footers."""
    counts = None
    for name in SCHEMAS:
        table = load(spark, sf, name)
        one = table.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(table.columns)).alias("n_columns")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS amount,
           CAST(o_orderdate AS DATE) AS day,
           o_orderstatus = 'P' AS is_bad
    FROM orders
    """
)
def csv_with_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV, where open amounts read 'pending', and back."""
    pending = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    lines = load(spark, sf, "orders").select(
        "o_orderkey", pending.alias("amount"), F.col("o_orderdate").cast("date").alias("day")
    )
    path = shared_path(spark, "orders-csv")
    write_text(lines, path, "csv", header="true")
    back = read_text(
        spark, path, "csv", "o_orderkey bigint, amount decimal(12,2), day date", "bad_row", header="true"
    )
    return back.select(
        "o_orderkey", F.col("amount").cast("double").alias("amount"), "day", F.col("bad_row").isNotNull().alias("is_bad")
    )


@query(
    """
    SELECT CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
           event_type = 'error' AS is_bad, count(*) AS n
    FROM events GROUP BY 1, 2
    """
)
def json_with_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as JSON lines, torn off for errors, and back."""
    torn = F.when(F.col("event_type") == "error", F.regexp_replace("props", r"\}$", "")).otherwise(F.col("props"))
    path = shared_path(spark, "events-json")
    write_text(load(spark, sf, "events").select(torn.alias("value")), path, "text")
    back = read_text(spark, path, "json", "k bigint", "bad_row")
    return back.groupBy("k", F.col("bad_row").isNotNull().alias("is_bad")).agg(F.count(F.lit(1)).alias("n"))


def _orders_by_year(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "orders-by-year")
    write_by(load(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), path, ["y"])
    return read_by(spark, path, f"{SCHEMAS['orders']}, y int")


@query(
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
    """
)
def partitioned_read_back(spark: SparkSession, sf: str) -> DataFrame:
    return _orders_by_year(spark, sf).groupBy("y").agg(
        F.count(F.lit(1)).alias("n_orders"), total(cents("o_totalprice")).alias("total")
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y
    FROM orders WHERE year(o_orderdate) = 1997
    """
)
def partition_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    """Reads one year's folder only."""
    return filters.pick(
        _orders_by_year(spark, sf), ["o_orderkey", "o_custkey", "o_totalprice", "y"], F.col("y") == 1997
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS saved
    FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
      AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24
    """
)
def filtered_lineitems(spark: SparkSession, sf: str) -> DataFrame:
    saved = amount(hundredths("l_extendedprice") * hundredths("l_discount"), 4)
    return filters.pick(
        load(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", saved.alias("saved")],
        filters.between("l_shipdate", datetime(1997, 1, 1), datetime(1998, 1, 1))
        & F.col("l_discount").between(0.05, 0.07)
        & (F.col("l_quantity") < 24),
    )


@query(
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
    WHERE (p_name LIKE '%widget' OR p_name LIKE 'cold %') AND p_type IN ('ECONOMY', 'STANDARD', 'PROMO')
      AND NOT (nullif(p_brand, 'Brand#13') IS NOT DISTINCT FROM NULL) AND p_size BETWEEN 5 AND 40
    """
)
def part_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """like, in, range and null-safe equality in one filter."""
    return filters.pick(
        load(spark, sf, "part"),
        ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
        filters.any_like("p_name", ["%widget", "cold %"])
        & F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO")
        & ~filters.same(F.nullif("p_brand", F.lit("Brand#13")), F.lit(None).cast("string"))
        & F.col("p_size").between(5, 40),
    )


_NET = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


@query(
    f"""
    SELECT n_name, p_type, count(*) AS n_lines, CAST(sum({_NET}) AS DOUBLE) AS revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
    WHERE r_name = 'ASIA' GROUP BY 1, 2
    """
)
def star_join_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitems with supplier, nation, region and part."""
    region = load(spark, sf, "region").where(F.col("r_name") == "ASIA").select("r_regionkey")
    makers = joins.star(
        load(spark, sf, "supplier").select("s_suppkey", "s_nationkey"),
        [(load(spark, sf, "nation"), "s_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")],
    ).select("s_suppkey", "n_name")
    joined = joins.star(
        load(spark, sf, "lineitem"),
        [(makers, "l_suppkey", "s_suppkey"), (load(spark, sf, "part").select("p_partkey", "p_type"), "l_partkey", "p_partkey")],
    )
    return aggregates.summary(
        joined,
        ["n_name", "p_type"],
        {"n_lines": F.count(F.lit(1)), "revenue": total(net("l_extendedprice", "l_discount"), 4)},
    )


@query(
    f"""
    SELECT n_name, CAST(sum({_NET}) AS DOUBLE) AS revenue
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
         JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE r_name = 'ASIA' GROUP BY 1
    """
)
def nation_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Region down to lineitem, small to large. The last join keeps a fifth of
    the orders; an order with very many lines is split by adaptive execution."""
    region = load(spark, sf, "region").where(F.col("r_name") == "ASIA").select("r_regionkey")
    buyers = joins.star(
        load(spark, sf, "customer").select("c_custkey", "c_nationkey"),
        [(load(spark, sf, "nation"), "c_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")],
    ).select("c_custkey", "n_name")
    bought = joins.star(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), [(buyers, "o_custkey", "c_custkey")])
    lines = joins.star(
        load(spark, sf, "lineitem"), [(bought.select("o_orderkey", "n_name"), "l_orderkey", "o_orderkey")]
    )
    return aggregates.summary(lines, ["n_name"], {"revenue": total(net("l_extendedprice", "l_discount"), 4)})


@query(
    """
    SELECT o_orderkey, o_orderpriority, coalesce(l_linenumber, 0) AS l_linenumber,
           coalesce(l_quantity, 0.0) AS l_quantity, l_partkey
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """
)
def orders_with_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Left outer join, unmatched orders filled."""
    return joins.outer(
        load(spark, sf, "orders").select("o_orderkey", "o_orderpriority"),
        load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey"),
        [("o_orderkey", "l_orderkey")],
        "left",
        {"l_linenumber": 0, "l_quantity": 0.0},
    ).drop("l_orderkey")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, o_orderkey, coalesce(o_orderpriority, 'none') AS o_orderpriority
    FROM (SELECT * FROM orders WHERE o_orderstatus <> 'O')
         RIGHT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
    """
)
def returned_lines_with_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Right outer join: returned lines, with their order unless it is open."""
    return joins.outer(
        load(spark, sf, "orders").where(F.col("o_orderstatus") != "O").select("o_orderkey", "o_orderpriority"),
        load(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_suppkey"),
        [("o_orderkey", "l_orderkey")],
        "right",
        {"o_orderpriority": "none"},
    ).select("l_orderkey", "l_linenumber", "l_suppkey", "o_orderkey", "o_orderpriority")


_YEARS = """
    (SELECT o_custkey AS {p}_custkey, count(*) AS {p}_orders FROM orders WHERE year(o_orderdate) = {y} GROUP BY 1)
"""


@query(
    f"""
    SELECT coalesce(a_custkey, b_custkey) AS custkey, coalesce(a_orders, 0) AS orders_1997,
           coalesce(b_orders, 0) AS orders_1998
    FROM {_YEARS.format(p="a", y=1997)} FULL JOIN {_YEARS.format(p="b", y=1998)} ON a_custkey = b_custkey
    """
)
def two_years_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer join of customers active in either year."""

    def active(prefix: str, year: int) -> DataFrame:
        in_year = filters.between("o_orderdate", datetime(year, 1, 1), datetime(year + 1, 1, 1))
        orders = load(spark, sf, "orders").where(in_year)
        return orders.groupBy(F.col("o_custkey").alias(f"{prefix}_custkey")).agg(
            F.count(F.lit(1)).alias(f"{prefix}_orders")
        )

    both = joins.outer(
        active("a", 1997), active("b", 1998), [("a_custkey", "b_custkey")], "full", {"a_orders": 0, "b_orders": 0}
    )
    return both.select(
        F.coalesce("a_custkey", "b_custkey").alias("custkey"),
        F.col("a_orders").alias("orders_1997"),
        F.col("b_orders").alias("orders_1998"),
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """
)
def orders_with_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Left semi join."""
    returned = load(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.having_match(orders, returned, [("o_orderkey", "l_orderkey")])


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """
)
def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Left anti join."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.without_match(orders, load(spark, sf, "lineitem"), [("o_orderkey", "l_orderkey")])


@query(
    """
    SELECT p.event_id AS purchase_id, c.event_id AS click_id, p.user_id
    FROM events p JOIN events c ON p.user_id = c.user_id
     AND c.ts BETWEEN p.ts - INTERVAL 24 HOUR AND p.ts
    WHERE p.event_type = 'purchase' AND c.event_type = 'click'
    """
)
def clicks_before_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """Interval join: clicks up to 24 hours before a purchase of the same user."""
    events = load(spark, sf, "events")
    purchases = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought_at")
    )
    clicks = events.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), F.col("ts").alias("clicked_at")
    )
    pairs = joins.within(purchases, clicks, ("user_id", "clicker"), ("bought_at", "clicked_at"), 24 * 3600)
    return pairs.select("purchase_id", "click_id", "user_id")


@query(
    """
    SELECT p.event_id, p.user_id, count(c.event_id) AS n_clicks,
           CAST(coalesce(sum(CAST(c.value AS DECIMAL(12,2))), 0) AS DOUBLE) AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON p.user_id = c.user_id AND c.ts BETWEEN p.ts - INTERVAL 24 HOUR AND p.ts
    GROUP BY 1, 2
    """
)
def click_counts_before_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """The same interval, counted and summed per purchase without the pairs."""
    events = load(spark, sf, "events")
    purchases = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    clicks = events.where(F.col("event_type") == "click").select("user_id", "ts", "value")
    counted = joins.count_within(purchases, clicks, ["user_id"], "ts", 24 * 3600, cents("value"))
    return counted.select(
        "event_id", "user_id", F.col("n").alias("n_clicks"), amount("total").alias("click_value")
    )


@query(
    """
    SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.value AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON p.user_id = c.user_id AND p.ts >= c.ts
    """
)
def last_click_before_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """As-of join."""
    events = load(spark, sf, "events")
    purchases = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    clicks = events.where(F.col("event_type") == "click").select(
        "event_id", "user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value")
    )
    return joins.as_of(purchases, clicks, ["user_id"], "ts", "event_id", ["click_id", "click_value"])


@query(
    f"""
    SELECT l_returnflag, l_linestatus,
           CAST(sum(CAST(l_quantity AS DECIMAL(8,2))) AS DOUBLE) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_base_price,
           CAST(sum({_NET}) AS DOUBLE) AS sum_disc_price,
           CAST(sum({_NET} * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DOUBLE) AS sum_charge,
           CAST(sum(CAST(l_quantity AS DECIMAL(8,2))) AS DOUBLE) / count(*) AS avg_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_price,
           CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS avg_disc,
           min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
           count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2
    """
)
def pricing_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: grouped summary of shipped lines."""
    shipped = load(spark, sf, "lineitem").where(F.col("l_shipdate") <= F.lit(datetime(1998, 9, 2)))
    return aggregates.summary(
        shipped,
        ["l_returnflag", "l_linestatus"],
        {
            "sum_qty": total(cents("l_quantity")),
            "sum_base_price": total(cents("l_extendedprice")),
            "sum_disc_price": total(net("l_extendedprice", "l_discount"), 4),
            "sum_charge": total(gross("l_extendedprice", "l_discount", "l_tax"), 6),
            "avg_qty": mean(cents("l_quantity")),
            "avg_price": mean(cents("l_extendedprice")),
            "avg_disc": mean(cents("l_discount")),
            "min_price": F.min("l_extendedprice"),
            "max_price": F.max("l_extendedprice"),
            "count_order": F.count(F.lit(1)),
        },
    )


_SEGMENTS = """
    SELECT c_mktsegment, o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS dearest,
           count(DISTINCT o_custkey) AS n_buyers
    FROM {customer} JOIN {orders} ON c_custkey = o_custkey
    WHERE c_acctbal > 0 GROUP BY c_mktsegment, o_orderpriority HAVING count(*) > 1
"""


@query(_SEGMENTS.replace("{", "").replace("}", ""))
def segment_orders_sql(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text, run by Spark."""
    return ask(spark, sf, _SEGMENTS)


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS distinct_l_partkey FROM lineitem GROUP BY 1")
def distinct_parts(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_counts(load(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey")


@query()
def distinct_parts_approx(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.distinct_counts(load(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey", rsd=0.02)


def _levels_sql(grouping: str) -> str:
    return f"""
    SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus, o_orderpriority) AS INTEGER) AS level,
           count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
           max(o_totalprice) AS dearest
    FROM orders GROUP BY {grouping}
    """


def _levels(spark: SparkSession, sf: str, kind: str, chosen=None) -> DataFrame:
    found = aggregates.levels(
        load(spark, sf, "orders"),
        ["o_orderstatus", "o_orderpriority"],
        kind,
        {"n_orders": F.count(F.lit(1)), "total": F.sum(cents("o_totalprice")), "dearest": F.max("o_totalprice")},
        chosen,
        {"n_orders": F.sum, "total": F.sum, "dearest": F.max},
    )
    return found.withColumn("total", amount("total"))


@query(_levels_sql("ROLLUP (o_orderstatus, o_orderpriority)"))
def order_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf, "rollup")


@query(_levels_sql("CUBE (o_orderstatus, o_orderpriority)"))
def order_cube(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf, "cube")


@query(_levels_sql("GROUPING SETS ((o_orderstatus), (o_orderpriority))"))
def order_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf, "sets", [["o_orderstatus"], ["o_orderpriority"]])


_STATUS = ["F", "O", "P"]


@query(
    "SELECT o_orderpriority, "
    + ", ".join(
        f"CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (o_orderstatus = '{s}') AS DOUBLE) AS {s}" for s in _STATUS
    )
    + " FROM orders GROUP BY 1"
)
def status_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.pivot(
        load(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", _STATUS, total(cents("o_totalprice"))
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, measure, amount FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount', l_discount FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem)
    """
)
def line_measures_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.unpivot(
        load(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_partkey"],
        ["l_quantity", "l_discount", "l_tax"],
        "measure",
        "amount",
    )


_FRACTIONS = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


@query(
    "SELECT l_returnflag, "
    + ", ".join(
        f"round(quantile_cont(l_extendedprice, {p}), 4) AS {n}"
        for n, p in _FRACTIONS.items()
    )
    + " FROM lineitem GROUP BY 1"
)
def price_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact, interpolated."""
    exact = aggregates.exact_quantiles(
        load(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_extendedprice"), _FRACTIONS
    )
    return exact.select("l_returnflag", *[F.round(n, 4).alias(n) for n in _FRACTIONS])


@query()
def price_quantiles_approx(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.approx_quantiles(
        load(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", _FRACTIONS, 10_000
    )


@query(
    """
    SELECT l_returnflag, round(avg(l_extendedprice), 2) AS mean, round(stddev_samp(l_extendedprice), 2) AS stddev,
           round(var_samp(l_extendedprice), 0) AS variance
    FROM lineitem GROUP BY 1
    """
)
def price_spread(spark: SparkSession, sf: str) -> DataFrame:
    spread = aggregates.spread(load(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return spread.select(
        "l_returnflag",
        F.round("mean", 2).alias("mean"),
        F.round("stddev", 2).alias("stddev"),
        F.round("variance", 0).alias("variance"),
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
    """
)
def dearest_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Top-k report."""
    return sorting.top(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
        25,
    )


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def customers_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return sorting.ordered(
        load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"),
        [F.asc("c_mktsegment"), F.desc("c_acctbal"), F.asc("c_custkey")],
    )


_SET_WORDS = {
    "union": "UNION",
    "union_all": "UNION ALL",
    "intersect": "INTERSECT",
    "intersect_all": "INTERSECT ALL",
    "except": "EXCEPT",
    "except_all": "EXCEPT ALL",
}


def _register_set(kind: str, word: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        orders = load(spark, sf, "orders").select(
            F.col("o_custkey").alias("custkey"), F.year("o_orderdate").cast("long").alias("y"), "o_orderpriority"
        )
        a = orders.where(F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority")
        b = orders.where(F.col("o_orderpriority") == "5-LOW").drop("o_orderpriority")
        return sets.combine(a, b, kind)

    run.__name__ = f"urgent_and_low_{kind}"
    run.__doc__ = "Customer-years with urgent orders, combined with those with low ones."
    side = "SELECT o_custkey AS custkey, year(o_orderdate) AS y FROM orders WHERE o_orderpriority = '{}'"
    query(f"{side.format('1-URGENT')} {word} {side.format('5-LOW')}")(run)


for _kind, _word in _SET_WORDS.items():
    _register_set(_kind, _word)
