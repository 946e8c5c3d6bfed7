"""Extension points in Python, for what has no built-in form.

A Python function is opaque to the optimiser and pays for moving its data, so
these stay small helpers; the grouping around them is Spark's.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.LongType())
def digit_sum(values: pa.Array) -> pa.Array:
    """Sum of the decimal digits of whole numbers; null stays null.

    The integers never become floats, and unsigned magnitudes hold the
    smallest long, too.
    """
    missing = values.is_null().to_numpy(zero_copy_only=False)
    left = np.abs(values.cast(pa.int64()).fill_null(0).to_numpy()).astype(np.uint64)
    out = np.zeros(len(left), np.int64)
    while left.any():
        out += (left % 10).astype(np.int64)
        left //= 10
    return pa.array(out, pa.int64(), mask=missing)


def grouped_partials(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A user-defined aggregate in partial form: (keys, n, total, peak).

    ``mapInArrow`` reduces each Arrow batch, never a whole group, and the
    partial rows are merged by built-in aggregates. The group may have any
    size, unlike with a grouped Pandas function, which holds it in one task.
    Values are whole numbers, so that merging is exact; others are refused.
    """
    keys = list(keys)
    kind = df.schema[value].dataType
    if not (isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0):
        raise TypeError(f"{value} must hold whole numbers, not {kind.simpleString()}")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    rows = df.select(*keys, F.col(value).cast("long").alias("_value"))
    parts = rows.mapInArrow(batch_partials(keys, "_value"), f"{schema}, n bigint, total bigint, peak bigint")
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("peak").alias("peak")
    )


def batch_partials(keys: list[str], value: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that gives, per batch and key, the number, sum and maximum
    of the non-null values. Made here so that it travels to the workers whole."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by(keys)
            found = grouped.aggregate([(value, "count"), (value, "sum"), (value, "max")])
            found = found.select([*keys, f"{value}_count", f"{value}_sum", f"{value}_max"])
            yield from found.rename_columns([*keys, "n", "total", "peak"]).to_batches()

    return reduce


def trend_per_group(df: DataFrame, key: str, position: Column, value: Column) -> DataFrame:
    """(key, points, slope): least-squares line through one total per position.

    Rows are added up per (key, position) before a group goes to Python, so a
    group holds one row per position (a day, say) and not its raw rows.
    """
    points = df.groupBy(F.col(key).alias("key"), position.cast("double").alias("x")).agg(
        F.sum(value).cast("double").alias("y")
    )
    points = points.dropna(subset=["x", "y"])

    def fit(group: pa.Table) -> pa.Table:
        x, y = group.column("x").to_numpy(), group.column("y").to_numpy()
        x = x - x.mean()
        spread = float((x * x).sum())
        slope = float((x * y).sum() / spread) if spread > 0 else None
        return pa.table(
            {
                "key": group.column("key").slice(0, 1),
                "points": pa.array([len(x)], pa.int64()),
                "slope": pa.array([slope], pa.float64()),
            }
        )

    key_type = points.schema["key"].dataType.simpleString()
    fitted = points.groupBy("key").applyInArrow(fit, f"key {key_type}, points bigint, slope double")
    return fitted.withColumnRenamed("key", key)


LINE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("n_chars", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
    ]
)
_BLANKS = " \t\n\f\r"
_WORD = re.compile(rf"[^{_BLANKS}]+")


@F.arrow_udtf(returnType=LINE)
class TextLines:
    """One row per line of each text (id, text) that is more than spaces, numbered from 1.

    Call it on a whole table, ``TextLines(df.asTable())``: batches of many texts
    come as Arrow and go as Arrow, dealt over tasks as the table is. Words are
    parted by ASCII blanks; other white space belongs to them. A null text has
    no line.
    """

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        for at in range(0, rows.num_rows, 1_000):
            some = rows.slice(at, 1_000)
            found = [
                (key, number, len(line), sum(1 for _ in _WORD.finditer(line)))
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist())
                for number, line in enumerate((text or "").split("\n"), start=1)
                if line.strip(" ")
            ]
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            columns = list(zip(*found)) or [()] * 4
            yield pa.table({n: pa.array(c, t) for n, c, t in zip(LINE.names, columns, types)})
