"""Bounded numpy tables as files that every executor keeps a copy of and maps into memory.

The file is written to the shared folder and named to Spark, which copies it
to each executor, also to one that takes a lost one's place. All Python workers
of an executor map the same copy.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import shared_path


def _packed(arrays: Mapping[str, np.ndarray]) -> bytes:
    """A line of names, types and lengths, then the arrays, each from a multiple of eight bytes."""
    head = json.dumps([[name, a.dtype.str, len(a)] for name, a in arrays.items()]).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    return head + b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays.values())


def unpacked(data: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a file's bytes, not copied."""
    at = int(np.flatnonzero(data[: 1 << 16] == ord("\n"))[0]) + 1
    out = {}
    for name, kind, n in json.loads(data[:at].tobytes()):
        size = n * np.dtype(kind).itemsize
        out[name] = data[at : at + size].view(kind)
        at += size + -size % 8
    return out


def ship(spark: SparkSession, label: str, arrays: Mapping[str, np.ndarray]) -> str:
    """Send one-dimensional arrays to all executors; the name to ``open_shipped`` them by there."""
    name = f"{label}-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_path(spark, 'shipped')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        data = _packed(arrays)
        for at in range(0, len(data), 8 << 20):
            out.write(bytearray(data[at : at + (8 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def open_shipped(name: str) -> dict[str, np.ndarray]:
    """Within a task: the arrays, mapped."""
    return unpacked(np.memmap(SparkFiles.get(name), np.uint8, "r"))


_BLOCK = 20  # bits of a place within a block of a bitmap


def _blocks(rows: pa.Table) -> pa.Table:
    bits = np.zeros(1 << _BLOCK, bool)
    bits[rows.column("place").to_numpy() & (1 << _BLOCK) - 1] = True
    return pa.table({"block": rows.column("block").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def ship_bitmap(places: DataFrame, bits: int) -> str | None:
    """Send out the bitmap of the column ``place``, numbers of so many bits; None if there is none."""
    found = places.select("place").distinct().withColumn("block", F.shiftright("place", _BLOCK))
    rows = found.groupBy("block").applyInArrow(_blocks, "block long, bits binary").collect()
    out = np.zeros((1 << max(0, bits - _BLOCK), 1 << _BLOCK - 3), np.uint8)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return ship(places.sparkSession, "bitmap", {"bitmap": out.reshape(-1)}) if rows else None


def in_bitmap(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    place = place.astype(np.uint64)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
