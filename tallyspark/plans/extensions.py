"""The Python extension points on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.exact import amount, cents
from tallyspark.functions.udfs import TextLines, digit_sum, grouped_partials, trend_per_group
from tallyspark.operators.heavy import heavy_hitters
from tallyspark.operators.sketches import distinct_in_all, distinct_in_any, quantiles_of, sketched
from tallyspark.plans.catalogue import Catalogue
from tallyspark.session import pinned, shared_path
from tallyspark.sources.labelled import register
from tallyspark.sources.tables import load

CATALOGUE = Catalogue()
query = CATALOGUE.query


@query(
    """
    SELECT event_id, list_sum(CAST(string_split(CAST(event_id AS VARCHAR), '') AS BIGINT[]))::BIGINT AS digits
    FROM events
    """
)
def event_digit_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Vectorised scalar function."""
    return load(spark, sf, "events").select("event_id", digit_sum("event_id").alias("digits"))


@query(
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total,
           CAST(max(CAST(l_quantity AS BIGINT)) AS BIGINT) AS peak
    FROM lineitem GROUP BY 1, 2
    """
)
def line_quantity_partials(spark: SparkSession, sf: str) -> DataFrame:
    """User-defined aggregate in partial form."""
    lines = load(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_quantity").cast("long").alias("quantity")
    )
    return grouped_partials(lines, ["l_returnflag", "l_linestatus"], "quantity")


@query(
    """
    WITH d AS (SELECT user_id, date_diff('day', TIMESTAMP '2024-01-01', ts) AS x,
                      CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS y
               FROM events GROUP BY 1, 2)
    SELECT user_id, count(*) AS points, round(regr_slope(y, x), 6) AS slope FROM d GROUP BY 1
    """
)
def daily_value_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Grouped function over daily totals."""
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    trend = trend_per_group(load(spark, sf, "events"), "user_id", day, cents("value"))
    return trend.select("user_id", "points", F.round(amount("slope"), 6).alias("slope"))


@query(
    r"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                      generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(length(line) AS INTEGER) AS n_chars,
           CAST(len([w FOR w IN string_split_regex(line, '\s+') IF w <> '']) AS INTEGER) AS n_words
    FROM l WHERE trim(line) <> ''
    """
)
def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Table function over a whole table."""
    lines = TextLines(load(spark, sf, "documents").select("doc_id", "text").asTable())
    return lines.withColumnRenamed("id", "doc_id")


@query(
    r"""
    WITH w AS (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents), n AS (SELECT word FROM w WHERE word <> '')
    SELECT word, count(*) AS n FROM n GROUP BY 1 HAVING count(*) * 500 > (SELECT count(*) FROM n)
    """
)
def heaviest_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words that are more than one in 500, without a count of all words."""
    words = load(spark, sf, "documents").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
    return heavy_hitters(words, ["word"], 500)


@query()
def stored_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Users and values of any days from one sketch a day: (question, answer)."""
    events = load(spark, sf, "events")
    made = sketched(events, [F.col("ts").cast("date").alias("day")], {"users": F.col("user_id")}, {"value": F.col("value")})
    stored = pinned(made, "sketches")
    first, second = F.col("day") < "2024-01-08", F.col("day").between("2024-01-08", "2024-01-14")
    weeks = distinct_in_all(stored, "users", {"first_week": first, "second_week": second})
    month = distinct_in_any(stored, "users").withColumnRenamed("users", "month")
    quantiles = quantiles_of(stored, "value", [0.25, 0.5, 0.75])
    answers = weeks.select(*[F.col(c).cast("double").alias(c) for c in weeks.columns]).unpivot([], weeks.columns, "question", "answer")
    answers = answers.union(month.select(F.lit("month"), F.col("month").cast("double")))
    return answers.union(quantiles.select(F.posexplode("value").alias("at", "answer")).select(F.concat(F.lit("quartile_"), F.col("at") + 1), "answer"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def events_as_labelled_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The events written and read back through a data source in Python."""
    events, folder = load(spark, sf, "events"), shared_path(spark, "labelled")
    register(spark)
    events.write.format("labelled").mode("append").save(folder)
    return spark.read.format("labelled").schema(events.schema).load(folder)
