"""Duplicates, quality rules and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row, by ``order``, of each set of rows equal in ``columns``.

    Texts are compared by their SHA-256 digest, so a text that is not itself
    wanted is read once and neither sorted nor shuffled. Each map task passes
    on one row per value, so a value with very many copies stays cheap.
    """
    texts = {f.name for f in df.schema if f.dataType.simpleString() in ("string", "binary")}
    keys = {f"_key_{c}": F.unhex(F.sha2(c, 256)) if c in texts else F.col(c) for c in columns}
    first = Window.partitionBy(*keys).orderBy(*order)
    keyed = df.withColumns(keys).withColumn("_nth", F.row_number().over(first))
    return keyed.where(F.col("_nth") == 1).drop("_nth", *keys)


def row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, bad_rows): how many rows break each rule, in one pass. A rule
    that comes out null counts as broken."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return counts.unpivot([], list(rules), "rule", "bad_rows")


def orphans(child: DataFrame, parent: DataFrame, foreign: str, key: str, rule: str) -> DataFrame:
    """(rule, bad_rows): child rows whose non-null foreign key has no parent.

    A foreign key with very many rows is split by adaptive execution; the
    parent side holds each key once.
    """
    known = parent.select(F.col(key).alias("_key")).distinct()
    lost = child.where(F.col(foreign).isNotNull()).join(known, F.col(foreign) == F.col("_key"), "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("bad_rows")).select(F.lit(rule).alias("rule"), "bad_rows")


def repeated_keys(df: DataFrame, columns: Sequence[str], rule: str) -> DataFrame:
    """(rule, bad_rows): number of keys that occur more than once."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return counts.agg(F.count(F.lit(1)).alias("bad_rows")).select(F.lit(rule).alias("rule"), "bad_rows")


def upsert(base: DataFrame, changes: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Newest row per key; at equal versions a change wins over the base.

    Among changes of one key and version the row is picked by its remaining
    columns, so the answer does not depend on the order of arrival.
    """
    rest = [c for c in base.columns if c not in key and c != version]
    both = base.withColumn("_src", F.lit(0)).unionByName(changes.withColumn("_src", F.lit(1)))
    newest = Window.partitionBy(*key).orderBy(F.desc(version), F.desc("_src"), *[F.desc(c) for c in rest])
    picked = both.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") == 1)
    return picked.select(*base.columns)
