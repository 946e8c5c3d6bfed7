"""A table that takes changes by key, a batch at a time, and rewrites only the parts they touch.

Rows are dealt over a fixed number of parts by a hash of the key. A batch of
changes is merged with the parts that its keys fall in; the other parts are not
read. New parts are written beside the old ones, then one small file says which
batch each part now stands in. That file is the commit: readers see all of a
batch or nothing of it, a batch that failed half-way is written anew, and a
batch whose number has been committed does nothing, so it may be sent again.

Below the root: ``data/batch=<number>/part=<number>/`` and
``published/batch=<number>/``. Batches must be sent one at a time, by growing
numbers. Old parts stay for readers that still read them; ``tidy`` removes them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.cleaning import upsert
from tallyspark.session import pinned, released


@dataclass(frozen=True)
class Merged:
    root: str
    schema: str
    key: Sequence[str]
    version: str
    parts: int = 64

    def _paths(self, spark: SparkSession, folder: str) -> list[str]:
        """The finished folders below one of the root's two."""
        top = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        return [s.getPath().toString() for s in fs.listStatus(top) if s.isDirectory()]

    def _published(self, spark: SparkSession) -> tuple[int, dict[int, int]]:
        """(the last committed batch, the batch that each part stands in); -1 before the first."""
        done = []
        for path in self._paths(spark, "published"):
            mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
            if mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
                done.append((int(path.rpartition("=")[2]), path))
        if not done:
            return -1, {}
        last, path = max(done)
        # One row for each part.
        return last, {r["part"]: r["stands_in"] for r in spark.read.schema("part int, stands_in long").parquet(path).collect()}

    def _read(self, spark: SparkSession, places: dict[int, int]) -> DataFrame:
        reader = spark.read.schema(self.schema)
        paths = [f"{self.root}/data/batch={batch}/part={part}" for part, batch in sorted(places.items())]
        return reader.parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows as of the last committed batch."""
        return self._read(spark, self._published(spark)[1])

    def merge(self, changes: DataFrame, batch: int) -> bool:
        """Commit the changes as this batch; False if it has been committed before.

        The newest version of each key stays; at equal versions the change does.
        """
        spark = changes.sparkSession
        last, places = self._published(spark)
        if batch <= last:
            return False
        part = F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int")
        columns = spark.createDataFrame([], self.schema).columns
        kept = pinned(changes.select(*columns), "changes")
        touched = [r["part"] for r in kept.select(part.alias("part")).distinct().collect()]  # as many as there are parts, at most
        base = self._read(spark, {p: places[p] for p in touched if p in places})
        new = upsert(base, kept, list(self.key), self.version).withColumn("part", part)
        new.write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/data/batch={batch}")
        places = places | dict.fromkeys(touched, batch)
        rows = spark.createDataFrame(sorted(places.items()), "part int, stands_in long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/published/batch={batch}")
        released(kept)
        return True

    def tidy(self, spark: SparkSession) -> None:
        """Delete what no part stands in any more. Nobody may be reading an earlier batch."""
        last, places = self._published(spark)
        for folder, used in (("published", {last}), ("data", set(places.values()))):
            for path in self._paths(spark, folder):
                batch = int(path.rpartition("=")[2])
                if batch not in used and batch <= last:
                    old = spark._jvm.org.apache.hadoop.fs.Path(path)
                    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
