"""Typed scans of the Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of each table, as its files store them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table with its declared schema, so no file is opened to infer one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def ask(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """SQL over the tables, named in braces: ``SELECT count(*) FROM {orders}``.

    The same plans as the DataFrame functions; no view is left behind.
    """
    named = {name: load(spark, folder, name) for name in SCHEMAS if f"{{{name}}}" in text}
    return spark.sql(text, **named)


def load_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream of files.

    On a large backlog ``files_per_trigger`` bounds one micro-batch. The path
    is a glob because a stream takes a plain path for a folder, and a small
    table is a single file.
    """
    reader = spark.readStream.schema(SCHEMAS[name]).option("pathGlobFilter", "*.parquet")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{{{name}}}.parquet")
