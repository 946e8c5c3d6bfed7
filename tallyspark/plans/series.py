"""Windows, scalar functions, cleaning and event analysis on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from tallyspark.functions import calendar, nested, text, values
from tallyspark.functions.exact import amount, cents, micros, total
from tallyspark.operators import cleaning, frames, overlaps, sequences, sessions, windows
from tallyspark.plans.catalogue import Catalogue
from tallyspark.session import shared_path
from tallyspark.sources.merged import Merged
from tallyspark.sources.tables import load

CATALOGUE = Catalogue()
query = CATALOGUE.query


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice, row_number FROM (
      SELECT o_custkey, o_orderkey, o_totalprice,
             CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS row_number
      FROM orders) WHERE row_number <= 3
    """
)
def top_orders_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.top_per(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderdate,
           CAST(row_number() OVER t AS INTEGER) AS row_number, CAST(rank() OVER v AS INTEGER) AS rank,
           CAST(dense_rank() OVER v AS INTEGER) AS dense_rank, CAST(ntile(4) OVER t AS INTEGER) AS ntile
    FROM orders
    WINDOW t AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
           v AS (PARTITION BY o_custkey ORDER BY o_orderdate)
    """
)
def order_ranks(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return windows.ranks(orders, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")], ["o_orderdate"], 4)


@query(
    """
    SELECT event_id, user_id, event_type,
           lag(event_type) OVER w AS prev_event_type,
           first_value(event_type) OVER w AS first_event_type,
           epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap_micros
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """
)
def event_gaps(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    stepped = windows.change(events, ["user_id"], [F.asc("ts"), F.asc("event_id")], ["event_type", "ts"])
    return stepped.select(
        "event_id",
        "user_id",
        "event_type",
        "prev_event_type",
        "first_event_type",
        (micros("ts") - micros("prev_ts")).alias("gap_micros"),
    )


@query(
    """
    SELECT event_id, user_id, lead(event_type) OVER w AS next_event_type, lead(value) OVER w AS next_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """
)
def next_events(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    stepped = windows.following(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], ["event_type", "value"])
    return stepped.select("event_id", "user_id", "next_event_type", "next_value")


@query(
    """
    SELECT event_id, user_id,
           CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) AS running_total,
           count(*) OVER w AS running_n
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """
)
def running_value(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    totals = {"running_total": cents("value"), "running_n": F.lit(1)}
    run = windows.running(events, ["user_id"], [F.asc("ts"), F.asc("event_id")], totals)
    return run.select("event_id", "user_id", amount("running_total").alias("running_total"), "running_n")


@query(
    """
    SELECT event_id, user_id, count(*) OVER w AS moving_n,
           CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) AS moving_total
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
    """
)
def moving_hour(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    sums = {"moving_n": F.lit(1), "moving_total": cents("value")}
    moved = windows.moving(events, ["user_id"], "ts", 3600, sums)
    return moved.select("event_id", "user_id", "moving_n", amount("moving_total").alias("moving_total"))


@query(
    r"""
    SELECT lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)) AS host,
           regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) AS utm_source,
           count(*) AS n_pages
    FROM pages GROUP BY 1, 2
    """
)
def page_hosts(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages").select("url")
    return pages.groupBy(
        text.host("url").alias("host"), text.url_parameter("url", "utm_source").alias("utm_source")
    ).agg(F.count(F.lit(1)).alias("n_pages"))


@query(
    """
    SELECT p_partkey, upper(p_name[1]) || p_name[2:] AS title, string_split(p_name, ' ')[1] AS adjective,
           string_split(p_name, ' ')[2] AS noun, CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INTEGER) AS brand_no
    FROM part
    """
)
def part_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.split("p_name", " ")
    return load(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)")).alias("title"),
        F.get(name, F.lit(0)).alias("adjective"),
        F.get(name, F.lit(1)).alias("noun"),
        F.regexp_extract("p_brand", "#([0-9]+)", 1).cast("int").alias("brand_no"),
    )


@query(
    r"""
    SELECT conv_id, turn, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS cleaned, length(text) AS n_chars
    FROM conversations
    """
)
def conversation_clean(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "conversations").select(
        "conv_id", "turn", text.clean("text").alias("cleaned"), F.length("text").cast("long").alias("n_chars")
    )


@query(
    r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1
    """
)
def document_words(spark: SparkSession, sf: str) -> DataFrame:
    return text.word_count(load(spark, sf, "documents"), "text")


@query(
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate) AS period, count(*) AS n_orders,
                      CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
               FROM orders GROUP BY 1)
    SELECT CAST(period AS TIMESTAMP) AS period, n_orders, total, lag(total) OVER (ORDER BY period) AS previous,
           round((total - lag(total) OVER (ORDER BY period)) / lag(total) OVER (ORDER BY period), 8) AS growth
    FROM m
    """
)
def monthly_orders(spark: SparkSession, sf: str) -> DataFrame:
    months = calendar.by_period(
        load(spark, sf, "orders"),
        "o_orderdate",
        "month",
        {"n_orders": F.count(F.lit(1)), "total": total(cents("o_totalprice"))},
    )
    return calendar.growth(months, "total", "month").withColumn("growth", F.round("growth", 8))


@query(
    """
    SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, month(o_orderdate) AS month,
           dayofweek(o_orderdate) + 1 AS weekday, last_day(CAST(o_orderdate AS DATE)) AS month_end, count(*) AS n_orders
    FROM orders GROUP BY ALL
    """
)
def order_calendar(spark: SparkSession, sf: str) -> DataFrame:
    parts = calendar.day_parts("o_orderdate")
    return load(spark, sf, "orders").groupBy(*[c.alias(n) for n, c in parts.items()]).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


@query(
    """
    SELECT CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 150000 THEN 1
                     WHEN o_totalprice < 300000 THEN 2 ELSE 3 END AS INTEGER) AS band,
           CAST(CASE WHEN o_totalprice >= 500000 THEN 11 WHEN o_totalprice < 0 THEN 0
                     ELSE floor(o_totalprice / 50000) + 1 END AS BIGINT) AS slice,
           count(*) AS n_orders,
           count(*) FILTER (o_orderpriority = '1-URGENT')::DOUBLE / count(*) AS urgent_share
    FROM orders GROUP BY 1, 2
    """
)
def price_bands(spark: SparkSession, sf: str) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        load(spark, sf, "orders")
        .groupBy(
            values.bucket("o_totalprice", [50_000, 150_000, 300_000]).alias("band"),
            values.equal_width("o_totalprice", 0, 500_000, 10).alias("slice"),
        )
        .agg(
            n.alias("n_orders"),
            values.ratio(F.count_if(F.col("o_orderpriority") == "1-URGENT"), n).alias("urgent_share"),
        )
    )


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query(f"SELECT event_id, {_K} AS by_path, {_K} AS by_schema, {_K} AS by_variant FROM events")
def event_properties(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON field, three ways."""
    return load(spark, sf, "events").select(
        "event_id",
        nested.json_field("props", "$.k", "bigint").alias("by_path"),
        nested.json_struct("props", "k bigint")["k"].alias("by_schema"),
        nested.json_variant("props", "$.k", "bigint").alias("by_variant"),
    )


@query(
    """
    SELECT user_id, string_agg(event_type, ',' ORDER BY ts DESC, event_id DESC) AS newest
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n <= 5 GROUP BY 1
    """
)
def newest_event_types(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    lists = nested.newest_list(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], F.col("event_type"), 5)
    return lists.select("user_id", F.array_join("items", ",").alias("newest"))


# The kinds of event in the table.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "SELECT user_id, "
    + " || ',' || ".join(f"'{t}=' || count(*) FILTER (event_type = '{t}')" for t in EVENT_TYPES)
    + " AS counts FROM events GROUP BY 1"
)
def event_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    maps = nested.count_map(load(spark, sf, "events"), ["user_id"], "event_type", EVENT_TYPES)
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("user_id", F.array_join(entries, ",").alias("counts"))


@query(
    """
    WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0),
    s AS (SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM q)), 6) AS similarity
          FROM embeddings)
    SELECT vec_id, similarity FROM s ORDER BY similarity DESC, vec_id LIMIT 20
    """
)
def nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 vectors most like vector 0, which is looked up as one row."""
    embeddings = load(spark, sf, "embeddings")
    asked = embeddings.where(F.col("vec_id") == 0).select("embedding").first()
    # Without vector 0 there is nothing to compare with, and every similarity is null.
    query_vector = asked["embedding"] if asked else [0.0]
    return nested.nearest(embeddings, "vec_id", "embedding", query_vector, 20)


@query(
    """
    SELECT vec_id, label, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 5) AS squared,
           len([x FOR x IN embedding IF x > 0]) AS n_positive, list_max(embedding)::DOUBLE AS largest
    FROM embeddings
    """
)
def vector_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Array functions: transform, aggregate, filter, maximum."""
    vector = F.col("embedding")
    norm = nested.length(vector)
    return load(spark, sf, "embeddings").select(
        "vec_id",
        "label",
        F.round(norm * norm, 5).alias("squared"),
        F.size(F.filter(vector, lambda x: x > 0)).cast("long").alias("n_positive"),
        F.array_max(vector).cast("double").alias("largest"),
    )


@query(
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
    """
)
def distinct_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = load(spark, sf, "documents")
    return cleaning.dedupe(documents, ["text"], [F.asc("doc_id")]).select("doc_id", "lang", "source", "n_chars")


@query(
    """
    SELECT 'price_positive' AS rule, count(*) FILTER (NOT o_totalprice > 10000) AS bad_rows FROM orders
    UNION ALL SELECT 'status_known', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
    UNION ALL SELECT 'customer_present', count(*) FILTER (o_custkey IS NULL) FROM orders
    UNION ALL SELECT 'line_without_order', count(*) FROM lineitem
              WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
    UNION ALL SELECT 'order_without_line', count(*) FROM orders
              WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE o_orderkey = l_orderkey)
    UNION ALL SELECT 'line_key_repeated', count(*) FROM
              (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """
)
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    rules = {
        "price_positive": F.col("o_totalprice") > 10_000,
        "status_known": F.col("o_orderstatus").isin("F", "O"),
        "customer_present": F.col("o_custkey").isNotNull(),
    }
    return (
        cleaning.row_rules(orders, rules)
        .unionByName(cleaning.orphans(lines, orders, "l_orderkey", "o_orderkey", "line_without_order"))
        .unionByName(cleaning.orphans(orders, lines, "o_orderkey", "l_orderkey", "order_without_line"))
        .unionByName(cleaning.repeated_keys(lines, ["l_orderkey", "l_linenumber"], "line_key_repeated"))
    )


@query(
    """
    WITH base AS (SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version FROM orders),
    changes AS (
      SELECT o_orderkey, 'F' AS o_orderstatus, o_totalprice, 2 AS version FROM orders WHERE o_orderstatus = 'O'
      UNION ALL SELECT o_orderkey, 'X', o_totalprice, 0 FROM orders WHERE o_orderstatus = 'P'
      UNION ALL SELECT -1 - o_orderkey, 'N', o_totalprice, 1 FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT o_orderkey, o_orderstatus, o_totalprice, version FROM
      (SELECT *, 0 AS src FROM base UNION ALL SELECT *, 1 FROM changes)
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, src DESC) = 1
    """
)
def orders_upserted(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders closed (newer), part orders changed too late (older), new keys added."""
    return cleaning.upsert(*_orders_and_changes(spark, sf), ["o_orderkey"], "version")


def _orders_and_changes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf, "orders")

    def change(where, key, status: str, version: int) -> DataFrame:
        rows = orders if where is None else orders.where(where)
        shown = F.col("o_orderstatus") if status == "" else F.lit(status)
        return rows.select(
            key.alias("o_orderkey"), shown.alias("o_orderstatus"), "o_totalprice", F.lit(version).alias("version")
        )

    key = F.col("o_orderkey")
    base = change(None, key, "", 1)
    changes = (
        change(F.col("o_orderstatus") == "O", key, "F", 2)
        .unionByName(change(F.col("o_orderstatus") == "P", key, "X", 0))
        .unionByName(change(F.col("o_orderpriority") == "1-URGENT", -1 - key, "N", 1))
    )
    return base, changes


@query(
    """
    WITH base AS (SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version FROM orders),
    changes AS (
      SELECT o_orderkey, 'F' AS o_orderstatus, o_totalprice, 2 AS version FROM orders WHERE o_orderstatus = 'O'
      UNION ALL SELECT o_orderkey, 'X', o_totalprice, 0 FROM orders WHERE o_orderstatus = 'P'
      UNION ALL SELECT -1 - o_orderkey, 'N', o_totalprice, 1 FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT o_orderkey, o_orderstatus, o_totalprice, version FROM
      (SELECT *, 0 AS src FROM base UNION ALL SELECT *, 1 FROM changes)
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, src DESC) = 1
    """
)
def orders_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes sent to a table in parts, the second batch twice."""
    base, changes = _orders_and_changes(spark, sf)
    schema = "o_orderkey long, o_orderstatus string, o_totalprice double, version int"
    table = Merged(shared_path(spark, "orders-merged"), schema, ["o_orderkey"], "version", parts=16)
    for batch, rows in enumerate((base, changes, changes)):
        table.merge(rows, min(batch, 1))
    return table.read(spark)


@query(
    """
    WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
    s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY ts) AS no FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM s GROUP BY user_id, no
    """
)
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    found = sessions.sessions(load(spark, sf, "events"), "user_id", "ts", 1800, cents("value"))
    return found.withColumn("total", amount("total"))


@query(
    """
    WITH a AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'view' GROUP BY 1),
    b AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN a USING (user_id)
          WHERE event_type = 'click' AND ts > a.t GROUP BY 1),
    c AS (SELECT e.user_id, min(ts) AS t FROM events e JOIN b USING (user_id)
          WHERE event_type = 'purchase' AND ts > b.t GROUP BY 1)
    SELECT a.user_id, a.t AS step_1, b.t AS step_2, c.t AS step_3
    FROM a LEFT JOIN b USING (user_id) LEFT JOIN c USING (user_id)
    """
)
def purchase_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.funnel(load(spark, sf, "events"), "user_id", "ts", "event_type", ["view", "click", "purchase"])


@query(
    """
    SELECT event_id, lag(event_type, 3) OVER w AS prev_event_type, lead(event_type, 3) OVER w AS next_event_type,
           lag(value, 3) OVER w AS prev_value, lead(value, 3) OVER w AS next_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """
)
def events_three_apart(spark: SparkSession, sf: str) -> DataFrame:
    """Values three events before and after."""
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    found = frames.shifted(events, ["user_id"], [F.asc("ts"), F.asc("event_id")], ["event_type", "value"], 3)
    return found.select("event_id", "prev_event_type", "next_event_type", "prev_value", "next_value")


@query(
    """
    SELECT event_id, min(value) OVER w AS low, max(value) OVER w AS high, median(value) OVER w AS middle, count(*) OVER w AS n
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 2 FOLLOWING)
    """
)
def moving_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Least, largest, median and number over a frame of rows."""
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")

    def make(w: WindowSpec) -> dict:
        frame = w.rowsBetween(-4, 2)
        made = {"low": F.min("value"), "high": F.max("value"), "middle": F.percentile("value", 0.5), "n": F.count(F.lit(1))}
        return {name: c.over(frame) for name, c in made.items()}

    found = frames.row_frames(events, ["user_id"], [F.asc("ts"), F.asc("event_id")], 4, 2, make)
    return found.select("event_id", "low", "high", "middle", "n")


@query(
    """
    SELECT event_id, min(value) OVER w AS low, max(value) OVER w AS high
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
    """
)
def moving_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Least and largest value of the last six hours, per kind of event."""
    events = load(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    found = frames.time_extremes(events, ["event_type"], "ts", 6 * 3600, {"low": ("min", "value"), "high": ("max", "value")})
    return found.select("event_id", "low", "high")


@query(
    """
    WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts) AS before FROM events),
    s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > CASE WHEN event_type = 'error' THEN INTERVAL 30 MINUTE ELSE INTERVAL 8 HOUR END THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts) AS no FROM g),
    t AS (SELECT user_id, event_type = 'error' AS failing, min(ts) AS a, max(ts) + CASE WHEN event_type = 'error' THEN INTERVAL 30 MINUTE ELSE INTERVAL 8 HOUR END AS b
          FROM s GROUP BY user_id, no, event_type = 'error', CASE WHEN event_type = 'error' THEN INTERVAL 30 MINUTE ELSE INTERVAL 8 HOUR END)
    SELECT x.user_id, x.a AS failing_from, x.b AS failing_to, y.a AS busy_from, y.b AS busy_to
    FROM t x JOIN t y ON x.user_id = y.user_id AND x.failing AND NOT y.failing AND x.a < y.b AND y.a < x.b
    """
)
def failing_while_busy(spark: SparkSession, sf: str) -> DataFrame:
    """Short sessions of errors that overlap long sessions of everything else, per user."""
    events = load(spark, sf, "events").select("user_id", "ts", "event_type")

    def spans(rows: DataFrame, minutes: int, user: str, names: tuple[str, str]) -> DataFrame:
        end = F.col("session_end") + F.expr(f"interval {minutes} minutes")
        found = sessions.sessions(rows, "user_id", "ts", minutes * 60, F.lit(0).cast("decimal(18,0)"))
        return found.select(F.col("user_id").alias(user), F.col("session_start").alias(names[0]), end.alias(names[1]))

    failing = spans(events.where("event_type = 'error'"), 30, "user_id", ("failing_from", "failing_to"))
    busy = spans(events.where("event_type <> 'error'"), 480, "other", ("busy_from", "busy_to"))
    pairs = overlaps.overlapping(failing, busy, ("user_id", "other"), (("failing_from", "failing_to"), ("busy_from", "busy_to")))
    return pairs.drop("other")


@query(
    """
    WITH g AS (SELECT *, lag(event_type) OVER w IS DISTINCT FROM event_type AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    n AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM g),
    r AS (SELECT user_id, run, event_type, count(*) AS n, min(ts) AS a, max(ts) AS b FROM n GROUP BY ALL),
    l AS (SELECT *, lag(event_type) OVER w AS t1, lag(n) OVER w AS n1, lag(event_type, 2) OVER w AS t2, lag(n, 2) OVER w AS n2,
                 lag(a, 2) OVER w AS a2, lag(b, 2) OVER w AS b2 FROM r WINDOW w AS (PARTITION BY user_id ORDER BY run))
    SELECT user_id, a2 AS started_at, a AS ended_at, n2 AS views, n1 AS clicks
    FROM l WHERE event_type = 'purchase' AND t1 = 'click' AND n1 <= 3 AND t2 = 'view' AND a - b2 <= INTERVAL 48 HOUR
    """
)
def views_clicks_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """Views, then one to three clicks, then a purchase within two days of the last view, nothing between."""
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    steps = [("view", 1, None), ("click", 1, 3), ("purchase", 1, 1)]
    found = sequences.sequences(events, ["user_id"], [F.asc("ts"), F.asc("event_id")], "event_type", "ts", steps, 48 * 3600)
    return found.select("user_id", "started_at", "ended_at", F.get("counts", F.lit(0)).alias("views"), F.get("counts", F.lit(1)).alias("clicks"))
