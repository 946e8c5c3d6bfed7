"""Pairs of overlapping intervals, without comparing all of a key's intervals.

Time is cut into cells at many levels, each twice as wide as the one below. An
interval lies in two cells at most of the first level whose cells are as wide as
it is long: its own level. It is entered there and at the own levels of longer
intervals of the other table. Two intervals meet at the own level of the longer
one, and the pair is made in the first cell that they share there, so no pair is
made twice and short intervals never meet a cell's worth of other short ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.exact import micros

_UNIT_BITS = 20  # cells of the lowest level: about a second


def _placed(df: DataFrame, side: str, on: str, span: tuple[str, str]) -> DataFrame:
    begin, end = micros(span[0]), micros(span[1])
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(f"_{side}")
    rows = df.where(F.col(on).isNotNull() & (begin < end)).select(
        whole, F.col(on).alias("_key"), begin.alias(f"_{side}_from"), (end - 1).alias(f"_{side}_to")
    )
    # The number of binary digits of the length above the unit.
    length = F.shiftright(F.col(f"_{side}_to") - F.col(f"_{side}_from"), _UNIT_BITS)
    return rows.withColumn(f"_{side}_level", F.when(length > 0, F.length(F.bin(length))).otherwise(0))


def _cell(at: str, level: Column) -> Column:
    return F.call_function("shiftright", F.col(at), level + _UNIT_BITS)


def _entered(rows: DataFrame, side: str, levels: list[int]) -> DataFrame:
    """A row for each cell of the interval's own level and of the longer levels named."""
    own = F.col(f"_{side}_level")
    wanted = F.array_distinct(F.concat(F.array(own), F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x > own)))
    each = rows.withColumn("_level", F.explode(wanted))
    first, last = (_cell(f"_{side}_{end}", F.col("_level")) for end in ("from", "to"))
    return each.withColumn("_cell", F.explode(F.sequence(first, last)))


def overlapping(left: DataFrame, right: DataFrame, on: tuple[str, str], spans: tuple[tuple[str, str], tuple[str, str]]) -> DataFrame:
    """All columns of both for each pair of equal key whose spans overlap.

    A span is (first, end), its end not included; spans that touch don't
    overlap, and those that are empty, turned round or null overlap nothing.
    Column names of the two tables must differ.
    """
    a, b = _placed(left, "a", on[0], spans[0]), _placed(right, "b", on[1], spans[1])
    # Some forty levels at most, so few numbers come to the driver.
    levels = {side: sorted(r[0] for r in rows.select(f"_{side}_level").distinct().collect()) for side, rows in (("a", a), ("b", b))}
    x = _entered(a, "a", levels["b"]).alias("x")
    y = _entered(b, "b", levels["a"]).alias("y")
    level = F.col("x._level")
    meet = (
        (F.col("x._key") == F.col("y._key")) & (level == F.col("y._level")) & (F.col("x._cell") == F.col("y._cell"))
        & (level == F.greatest("_a_level", "_b_level"))
        & (F.col("x._cell") == F.greatest(_cell("_a_from", level), _cell("_b_from", level)))
        & (F.col("_a_from") <= F.col("_b_to")) & (F.col("_b_from") <= F.col("_a_to"))
    )
    return x.join(y, meet).select("_a.*", "_b.*")
