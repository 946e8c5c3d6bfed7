"""Streams over the event files, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.exact import cents, hundredths, total
from tallyspark.plans.catalogue import Catalogue
from tallyspark.session import shared_path
from tallyspark.sources.merged import Merged
from tallyspark.sources.tables import load, load_stream
from tallyspark.streaming.joins import enrich, match
from tallyspark.streaming.run import finished, replayed, run_available, run_merged
from tallyspark.streaming.state import latest_state, running_state
from tallyspark.streaming.timed import baskets
from tallyspark.streaming.windows import stream_dedupe, stream_sessions, windowed

CATALOGUE = Catalogue()
query = CATALOGUE.query


def _aggs() -> dict:
    return {"n": F.count(F.lit(1)), "total": total(cents("value"))}


@query(
    """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2, 3
    HAVING window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
    """
)
def hourly_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling windows that the watermark has closed."""
    stream = load_stream(spark, sf, "events")
    return finished(windowed(stream, "ts", "1 hour", None, "1 hour", ["event_type"], _aggs()), "hourly")


@query(
    """
    WITH w AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * i AS window_start, value
               FROM events, (SELECT unnest([0, 1, 2, 3]) AS i))
    SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM w GROUP BY 1, 2
    HAVING window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
    """
)
def sliding_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Two hours, every half hour."""
    stream = load_stream(spark, sf, "events")
    return finished(windowed(stream, "ts", "2 hours", "30 minutes", "1 hour", [], _aggs()), "sliding")


@query(
    """
    WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
    s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY ts) AS no FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM s GROUP BY user_id, no
    HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
    """
)
def streamed_sessions(spark: SparkSession, sf: str) -> DataFrame:
    found = stream_sessions(load_stream(spark, sf, "events"), "ts", "30 minutes", "1 hour", ["user_id"], _aggs())
    return finished(found.select("user_id", "session_start", "session_end", "n", "total"), "sessions")


@query("SELECT event_id, ts, user_id, event_type FROM events")
def streamed_repeats_removed(spark: SparkSession, sf: str) -> DataFrame:
    """The event stream delivered twice comes out once."""
    twice = load_stream(spark, sf, "events").union(load_stream(spark, sf, "events"))
    once = stream_dedupe(twice, "ts", "1 hour", ["event_id"])
    out = once.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")
    return finished(out, "repeats")


@query(
    """
    SELECT event_id, user_id, event_type, c_mktsegment, c_nationkey
    FROM events LEFT JOIN customer ON user_id = c_custkey
    """
)
def streamed_with_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Stream joined with a table (users paired with customers of equal number)."""
    customers = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = enrich(load_stream(spark, sf, "events"), customers, ("user_id", "c_custkey"))
    return finished(joined.select("event_id", "user_id", "event_type", "c_mktsegment", "c_nationkey"), "enriched")


@query(
    """
    SELECT p.event_id AS purchase_id, c.event_id AS click_id, p.user_id
    FROM events p JOIN events c ON p.user_id = c.user_id AND c.ts BETWEEN p.ts - INTERVAL 6 HOUR AND p.ts
    WHERE p.event_type = 'purchase' AND c.event_type = 'click'
    """
)
def streamed_click_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams: clicks up to six hours before a purchase."""
    pairs = _clicks_of_purchases(load_stream(spark, sf, "events"), load_stream(spark, sf, "events"), "inner")
    return finished(pairs, "matches")


def _clicks_of_purchases(bought: DataFrame, clicked: DataFrame, how: str) -> DataFrame:
    purchases = bought.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought_at")
    )
    clicks = clicked.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), F.col("ts").alias("clicked_at")
    )
    pairs = match(purchases, clicks, ("user_id", "clicker"), ("bought_at", "clicked_at"), 6 * 3600, "1 hour", how)
    return pairs.select("purchase_id", "click_id", "user_id")


@query(
    """
    WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), c AS (SELECT * FROM events WHERE event_type = 'click')
    SELECT p.event_id AS purchase_id, c.event_id AS click_id, p.user_id
    FROM p LEFT JOIN c ON p.user_id = c.user_id AND c.ts BETWEEN p.ts - INTERVAL 6 HOUR AND p.ts
    WHERE c.event_id IS NOT NULL
       OR p.ts <= date_trunc('milliseconds', least((SELECT max(ts) FROM p), (SELECT max(ts) FROM c))) - INTERVAL 1 HOUR
    """
)
def streamed_clicks_or_none(spark: SparkSession, sf: str) -> DataFrame:
    """As ``streamed_click_matches``, with the purchases that no click came before, fed in order of time."""
    out, state = shared_path(spark, "alone-out"), shared_path(spark, "alone-state")

    def step(stream: DataFrame) -> None:
        run_available(_clicks_of_purchases(stream, stream, "left_outer"), out, state)

    events = load(spark, sf, "events")
    replayed(events, "ts", _edges(events, 3), "alone", step)
    return spark.read.schema("purchase_id long, click_id long, user_id long").parquet(out)


def _edges(rows: DataFrame, slices: int) -> list:
    """Times that cut a table's span into equal slices."""
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    return [] if first is None else [first + (last - first) * i / slices for i in range(1, slices)]


@query(
    """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2
    """
)
def hourly_windows_live(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly windows brought up to date with each micro-batch, those still open included."""
    schema = "window_start timestamp_ntz, event_type string, n long, total double"
    into = Merged(shared_path(spark, "live-windows"), schema, ["window_start", "event_type"], "n", parts=8)
    state = shared_path(spark, "live-state")

    def step(stream: DataFrame) -> None:
        run_merged(windowed(stream, "ts", "1 hour", None, "1 hour", ["event_type"], _aggs()), into, state)

    events = load(spark, sf, "events").select("ts", "event_type", "value")
    replayed(events, "ts", _edges(events, 3), "live", step)
    return into.read(spark)


@query(
    """
    SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2)) * 100) AS BIGINT) AS cents,
           CAST(max(CAST(value AS DECIMAL(12,2)) * 100) AS BIGINT) AS peak_cents
    FROM events GROUP BY 1
    """
)
def streamed_user_state(spark: SparkSession, sf: str) -> DataFrame:
    """Custom state per user."""
    history = finished(running_state(load_stream(spark, sf, "events"), "user_id", hundredths("value")), "state")
    return latest_state(history).select(
        F.col("key").alias("user_id"), "n", F.col("total").alias("cents"), F.col("peak").alias("peak_cents")
    )


@query(
    """
    WITH m AS (SELECT user_id, date_trunc('minute', ts) AS minute,
                      count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS buys
               FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL),
    n AS (SELECT *, min(CASE WHEN buys > 0 THEN minute END) OVER (PARTITION BY user_id ORDER BY minute
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bought_at FROM m),
    c AS (SELECT *, lag(minute) OVER w AS before, lag(bought_at) OVER w AS bought_before FROM n WHERE clicks > 0
          WINDOW w AS (PARTITION BY user_id ORDER BY minute)),
    b AS (SELECT *, sum(CASE WHEN before IS NULL OR minute - before > INTERVAL 2 HOUR OR bought_before < minute THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY minute) AS basket FROM c),
    d AS (SELECT user_id, min(minute) AS opened_at, max(minute) AS last_click, CAST(sum(clicks) AS BIGINT) AS clicks,
                 max_by(bought_at, minute) AS bought_at FROM b GROUP BY user_id, basket)
    SELECT user_id, opened_at, coalesce(bought_at <= last_click + INTERVAL 2 HOUR, false) AS bought,
           CASE WHEN bought_at <= last_click + INTERVAL 2 HOUR THEN bought_at ELSE last_click + INTERVAL 2 HOUR END AS closed_at, clicks
    FROM d WHERE closed_at <= (SELECT max(minute) FROM m) - INTERVAL 1 HOUR
    """
)
def streamed_baskets(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks collected until a purchase or two idle hours: state that a timer closes."""
    found = baskets(load_stream(spark, sf, "events"), "user_id", "ts", "event_type", "1 hour", 120)
    return finished(found.withColumnRenamed("key", "user_id"), "baskets")
