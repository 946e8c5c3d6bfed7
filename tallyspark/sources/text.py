"""CSV and JSON lines with a declared schema; bad rows are kept, not lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_text(spark: SparkSession, path: str, fmt: str, schema: str, bad_col: str, **options: str) -> DataFrame:
    """Rows that do not parse come out with nulls and their raw text in
    ``bad_col``. Files are split and parsed by the executors; nothing is
    inferred, so they are read once."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"fmt must be csv or json, not {fmt!r}")
    reader = (
        spark.read.format(fmt)
        .schema(f"{schema}, {bad_col} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad_col)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def write_text(df: DataFrame, path: str, fmt: str, **options: str) -> None:
    writer = df.write.format(fmt).mode("errorifexists")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(path)
