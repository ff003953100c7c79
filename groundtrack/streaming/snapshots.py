"""The latest fix per object as a table that each micro-batch only adds to.

``write_delta`` stores, under the batch's id, one row for each object that
reported in the batch: nothing is read, no state is kept, and what is written
grows with the objects that changed, not with all there are. ``read_latest``
merges on read: the base and the deltas behind it, the greatest ``(timestamp,
seq)`` of each object. After ``MAX_DELTAS`` deltas they are merged into a new
base. A retried batch overwrites its own delta; one that a base already holds
is not read again. Deltas and bases are dropped one generation late, so a
reader that listed them a moment ago still finds them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from groundtrack.operators.latest import latest_positions

COLUMNS = ("sat_id", "satname", "latitude", "longitude", "azimuth", "elevation", "timestamp", "seq")
SCHEMA = ("sat_id string, satname string, latitude double, longitude double, azimuth double, elevation double, "
          "timestamp bigint, seq bigint")
MAX_DELTAS = 8


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a folder, ascending (metadata only)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def _drop(spark: SparkSession, path: str, versions: list[int]) -> None:
    jvm = spark.sparkContext._jvm
    for v in versions:
        p = jvm.org.apache.hadoop.fs.Path(_folder(path, v))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _folder(path: str, version: int) -> str:
    return os.path.join(path, f"v={int(version):020d}")


def write_delta(batch: DataFrame, batch_id: int, path: str, max_deltas: int = MAX_DELTAS) -> None:
    """Add one micro-batch of accepted fixes to the table at ``path``."""
    spark = batch.sparkSession
    deltas, bases = os.path.join(path, "delta"), os.path.join(path, "base")
    latest_positions(batch.select(*COLUMNS)).write.mode("overwrite").parquet(_folder(deltas, batch_id))
    base = max(_versions(spark, bases), default=-1)
    if sum(v > base for v in _versions(spark, deltas)) > max_deltas:
        read_latest(spark, path).write.mode("overwrite").parquet(_folder(bases, batch_id))
        _drop(spark, deltas, [v for v in _versions(spark, deltas) if v <= base])
        _drop(spark, bases, [v for v in _versions(spark, bases) if v < base])


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest fix per object over all committed batches; None before the first."""
    deltas, bases = os.path.join(path, "delta"), os.path.join(path, "base")
    base = max(_versions(spark, bases), default=-1)
    folders = [_folder(deltas, v) for v in _versions(spark, deltas) if v > base]
    if base >= 0:
        folders.append(_folder(bases, base))
    return latest_positions(spark.read.schema(SCHEMA).parquet(*folders)) if folders else None
