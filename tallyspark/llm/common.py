"""What several operators of this subpackage need."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.session import bucketed, pinned, released

__all__ = ["BLANKS", "Memo", "ascii_lower", "bucketed", "held", "hold_out", "pinned", "released", "running_offsets", "slices", "table", "word_count", "word_hashes", "words"]

# The blanks between words: space and the ASCII controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the folder, with whatever schema its files have."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare != "", F.split(bare, _BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare != "", F.size(F.split(bare, _BLANK_RUN))).otherwise(0).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, everything else untouched."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hold_out(key: Column, folds: int, fold: int) -> Column:
    """True for the rows of one fold by the CRC of the key's text; a null key is learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def held(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns only, each as null where the table lacks it."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in columns])


def running_offsets(
    df: DataFrame, by: Sequence[str], spread: Column, order: Sequence[str], sums: dict[str, Column], per_bucket: int
) -> DataFrame:
    """Add to each row the sums over the rows before it in its group; without ``by``, all rows are one.

    No group goes through one window: its rows are dealt over as many buckets
    as hold ``per_bucket`` rows each by the hash ``spread``; sums are run
    inside each bucket, and over one row per bucket. ``order`` must settle the
    order of rows that differ.
    """
    if by:
        counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_group"))
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
        sized = df.alias("l").join(counted.alias("r"), same, "inner").select("l.*", "r._group")
        dealt = sized.withColumn("_bucket", F.pmod(spread, F.ceil(F.col("_group") / per_bucket))).drop("_group")
    else:  # counted now: joined to each row, the count would make a product
        dealt = df.withColumn("_bucket", F.pmod(spread, F.lit(parts_for(df.count(), per_bucket)).cast("long")))
    totals = dealt.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
    across = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*by, "_bucket", *[F.coalesce(F.sum(f"_sum_{n}").over(across), F.lit(0)).alias(f"_base_{n}") for n in sums])
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumns({f"_in_{n}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, "_bucket"]]
    joined = local.alias("l").join(bases.alias("r"), same, "inner").select("l.*", *[f"r._base_{n}" for n in sums])
    out = joined.withColumns({n: (F.col(f"_in_{n}") + F.col(f"_base_{n}")).cast("long") for n in sums})
    return out.drop("_bucket", *[f"_in_{n}" for n in sums], *[f"_base_{n}" for n in sums])


class Memo(dict):
    """Results of a function of bytes, kept for ``most`` short arguments and then begun anew.

    Make one for each task, not one for each worker: a worker outlives its
    tasks, and what it holds is missing from the executor's shuffles.
    """

    def __init__(self, fn: Callable[[bytes], object], most: int = 50_000) -> None:
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key: bytes) -> object:
        found = self.fn(key)
        if len(key) < 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = found
        return found


def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def slices(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows of ``size`` bytes or so, not copied: what a task makes of one stays small.

    Python workers share an executor's memory with a heap that does not shrink.
    """
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))
