"""Partitioned Parquet output and pruned reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by(df: DataFrame, path: str, columns: Sequence[str], rows_per_file: int = 5_000_000) -> None:
    """One folder per value of ``columns``, files of bounded size.

    The rebalance hint gathers each value's rows, so that tasks do not each
    open a file per value, and lets adaptive execution split a value that is
    too big for one task.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*columns)
        .parquet(path)
    )


def read_by(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same table; filters on its folder columns skip whole folders."""
    return spark.read.schema(schema).parquet(path)
