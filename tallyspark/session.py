"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. Adaptive execution splits skewed
# partitions of a join; the "force" flag lets it do so even where the split
# costs one more shuffle of the (already reduced) join result.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Arrow batches are bounded by bytes, too: ten thousand long rows would fill a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State on local disk with changes logged to the checkpoint: large state
    # neither fills the heap nor is written whole with every micro-batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Folders made for local sessions without one, by application.
_OWN_ROOTS: dict[str, str] = {}


def build_session(master: str, shuffle_partitions: int, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tallyspark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a session of one process may fall back to a folder of its own. The
    session's checkpoint folder is read, never set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    # "local", "local[8]", "local[8,2]": one process; local-cluster has executors of its own.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOTS:
        _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="tallyspark-")
    return _OWN_ROOTS[app]


def shared_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Where the tables that ``pinned`` and ``bucketed`` gave are written.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
# What those of ``bucketed`` are called in the catalogue.
_NAMES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def pinned(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, computed once.

    Unlike a plan, the table cannot come out differently when a lost executor
    makes Spark compute something again, and it survives the executors.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def bucketed(df: DataFrame, label: str, column: str) -> DataFrame:
    """The rows as ``pinned``, in buckets by a column: joins on it move the other side only.

    The table is a temporary one of the session's catalogue, its files are in the shared folder.
    """
    spark = df.sparkSession
    path, count = shared_path(spark, label), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tallyspark_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(count, column).option("path", path).saveAsTable(name)
    table = spark.table(name)
    _FOLDERS[table], _NAMES[table] = path, name
    return table


def released(*tables: DataFrame | None) -> None:
    """Delete tables that ``pinned`` or ``bucketed`` gave and that nothing reads any more, not even to compute a lost part anew.

    That is so once all that was made of them is itself pinned.
    """
    for table in tables:
        if table is not None and table in _FOLDERS:
            spark = table.sparkSession
            if table in _NAMES:
                spark.sql(f"DROP TABLE IF EXISTS {_NAMES.pop(table)}")
            path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(table))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
