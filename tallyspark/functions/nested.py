"""JSON, arrays, maps and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ordered import DEFAULT, Limits
from tallyspark.operators.sorting import top
from tallyspark.operators.windows import top_per


def json_field(column: str, path: str, kind: str) -> Column:
    """One field of a JSON text as ``kind``; null if absent or not of that kind."""
    return F.get_json_object(column, path).try_cast(kind)


def json_struct(column: str, schema: str) -> Column:
    """The whole text parsed once, for several fields."""
    return F.from_json(column, schema)


def json_variant(column: str, path: str, kind: str) -> Column:
    """Through the variant type; null for text that is not JSON."""
    return F.try_variant_get(F.try_parse_json(F.col(column)), path, kind)


def newest_list(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], item: Column, n: int, limits: Limits = DEFAULT
) -> DataFrame:
    """Per key an array of its first ``n`` items in ``order``.

    Trimmed to ``n`` before anything is collected, so no array grows with the
    data. Sorted by position, because collecting does not keep order.
    """
    first = top_per(df.withColumn("_item", item), by, order, n, limits)
    pairs = F.array_sort(F.collect_list(F.struct("row_number", "_item")))
    return first.groupBy(*by).agg(F.transform(pairs, lambda p: p["_item"]).alias("items"))


def count_map(df: DataFrame, by: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Per key a map from each listed value to its count.

    Conditional counts in one pass: nothing is collected, and the map is as
    long as the list.
    """
    entries = [part for v in values for part in (F.lit(v), F.count_if(F.col(column) == v))]
    return df.groupBy(*by).agg(F.create_map(*entries).alias("counts"))


def dot(vector: Column, other: Sequence[float]) -> Column:
    """Dot product with a fixed vector, in doubles, element by element."""
    fixed = F.array(*[F.lit(float(x)) for x in other])
    products = F.zip_with(vector, fixed, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def length(vector: Column) -> Column:
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def cosine(vector: Column, other: Sequence[float]) -> Column:
    norm = sum(float(x) * float(x) for x in other) ** 0.5
    return F.try_divide(dot(vector, other), length(vector) * F.lit(norm))


def nearest(df: DataFrame, key: str, vector: str, query: Sequence[float], k: int, digits: int = 6) -> DataFrame:
    """The ``k`` rows most similar to one query vector.

    The query travels as a literal: one scan, k rows per task, no join.
    """
    scored = df.select(key, F.round(cosine(F.col(vector), query), digits).alias("similarity"))
    return top(scored, [F.desc("similarity"), F.asc(key)], k)
