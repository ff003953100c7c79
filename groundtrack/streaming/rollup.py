"""What lookups need of the past, rolled up by day beside the archive.

A request sees the last fix, or the last motion vector, of every object; the
archive holds all of them. ``roll_up`` keeps, as of the start of a day, the last
fix and the last vector of each object, made from the roll-up before and the
days in between. ``cache`` and ``vectors`` then read one roll-up, the days from
it on, and whatever was archived later for the days before it (late fixes): the
archive of earlier days is never scanned for an answer. A roll-up is one folder
``v=<day>-<batch>``, made of all batches up to that one; it counts when both of
its tables are whole. Without any roll-up results are the same, read from the
last fixes of all days and the whole archive.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.functions.ordering import order_key
from groundtrack.operators import motion
from groundtrack.params import LOOKBACK_S
from groundtrack.streaming import sinks

FOLDER = "_rollup"          # beside the archive's folder
KEPT = 8                    # roll-ups kept, by the batch that made them
FIX = "sat_id string, satname string, latitude double, longitude double, azimuth double, elevation double, timestamp bigint, seq bigint, topic string"
VECTOR = ("sat_id string, satname string, timestamp bigint, seq bigint, prev_timestamp bigint, velocity_kmph double, "
          "delta_latitude double, delta_longitude double")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def rollups(spark: SparkSession, history: str) -> list[tuple[int, int]]:
    """(day, last batch) of the whole roll-ups (metadata only)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    root = path(history + FOLDER)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out = []
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith("v=") and all(fs.exists(path(f"{history}{FOLDER}/{name}/{t}/_SUCCESS")) for t in ("fixes", "vectors")):
            day, batch = name[2:].rsplit("-", 1)
            out.append((int(day), int(batch)))
    return sorted(out)


def _folder(history: str, day: int, batch: int, table: str) -> str:
    return f"{history}{FOLDER}/v={day}-{batch}/{table}"


def _at(spark: SparkSession, history: str, day: int) -> tuple[int, int] | None:
    """The latest roll-up made for ``day`` or a day before."""
    return max((r for r in rollups(spark, history) if r[0] <= day), default=None)


def _since(at: tuple[int, int], day: int) -> Column:
    """Rows of days before ``day`` that the roll-up does not hold."""
    return (F.col("day") < day) & ((F.col("day") >= at[0]) | (F.col("batch_id") > at[1]))


def _tails(spark: SparkSession, history: str) -> DataFrame:
    return spark.read.schema(sinks.ARCHIVE).parquet(history + sinks.TAILS)


def fixes_before(spark: SparkSession, history: str, day: int) -> DataFrame:
    """Fixes among which the last of each object before ``day`` is: the roll-up
    and the last fixes per day and batch behind it."""
    at = _at(spark, history, day)
    if at is None:
        return _tails(spark, history).where(F.col("day") < day).select(_names(FIX))
    newer = _tails(spark, history).where(_since(at, day)).select(_names(FIX))
    return spark.read.schema(FIX).parquet(_folder(history, *at, "fixes")).unionByName(newer)


def cache(spark: SparkSession, history: str, lo: int, hi: int) -> DataFrame:
    """The fixes that a lookup as of any time in [lo, hi] can return."""
    first = int(lo) // sinks.DAY_S
    return sinks.read_history(spark, history, first * sinks.DAY_S, hi).unionByName(fixes_before(spark, history, first))


def _vectors_of(spark: SparkSession, history: str, first: int, last: int, lookback_s: int) -> DataFrame:
    """Vectors of the fixes of days ``first`` .. ``last``."""
    start = first * sinks.DAY_S
    fixes = sinks.read_history(spark, history, start - lookback_s, (last + 1) * sinks.DAY_S - 1)
    return motion.motion_vectors(fixes, lookback_s).where(F.col("timestamp") >= start)


def vectors_before(spark: SparkSession, history: str, day: int, lookback_s: int = LOOKBACK_S) -> DataFrame | None:
    """Vectors among which the last of each object before ``day`` is, one row a
    fix; None where the archive begins with that day."""
    at = _at(spark, history, day)
    days = _tails(spark, history).where(_since(at, day) if at else F.col("day") < day).select("day").distinct()
    days = {r[0] for r in days.collect()}                          # one number a day
    if at:
        days |= {d + 1 for d in days if d + 1 < at[0]}             # a late fix of a day's end changes vectors of the next
    runs = []
    for d in sorted(days):
        runs.append([runs.pop()[0], d] if runs and runs[-1][1] == d - 1 else [d, d])
    made = None
    for first, last in runs:
        v = _vectors_of(spark, history, first, last, lookback_s)
        made = v if made is None else made.unionByName(v)
    if at is None:
        return made
    held = spark.read.schema(VECTOR).parquet(_folder(history, *at, "vectors"))
    if made is None:
        return held
    # what was made anew holds where both have a fix
    return made.unionByName(held.join(made.select("sat_id", "timestamp", "seq"), ["sat_id", "timestamp", "seq"], "left_anti"))


def vectors(spark: SparkSession, history: str, lo: int, hi: int, lookback_s: int = LOOKBACK_S) -> DataFrame:
    """The motion vectors that a lookup as of any time in [lo, hi] can return."""
    first, last = int(lo) // sinks.DAY_S, int(hi) // sinks.DAY_S
    now = _vectors_of(spark, history, first, last, lookback_s).where(F.col("timestamp") <= int(hi))
    before = vectors_before(spark, history, first, lookback_s)
    return now if before is None else now.unionByName(before.select(now.columns))


def _last_of(rows: DataFrame, schema: str) -> DataFrame:
    names = _names(schema)
    kept = rows.withColumn("_k", order_key()).groupBy("sat_id").agg(F.max_by(F.struct(*names), "_k").alias("l"))
    return kept.select("l.*")


def roll_up(spark: SparkSession, history: str, day: int, batch_id: int, lookback_s: int = LOOKBACK_S) -> None:
    """Write the roll-up of ``day`` from all batches archived so far, ``batch_id``
    being the last, and drop the oldest. A repeated call overwrites its own."""
    fixes = _last_of(fixes_before(spark, history, day), FIX)
    v = vectors_before(spark, history, day, lookback_s)
    v = spark.createDataFrame([], VECTOR) if v is None else _last_of(v, VECTOR)
    v.write.mode("overwrite").parquet(_folder(history, day, batch_id, "vectors"))
    fixes.write.mode("overwrite").parquet(_folder(history, day, batch_id, "fixes"))
    jvm = spark.sparkContext._jvm
    for old in sorted(rollups(spark, history), key=lambda r: (r[1], r[0]))[:-KEPT]:
        p = jvm.org.apache.hadoop.fs.Path(os.path.dirname(_folder(history, *old, "fixes")))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def advance(batch: DataFrame, batch_id: int, history: str, lookback_s: int = LOOKBACK_S) -> None:
    """After a batch was archived: a roll-up for its latest day, unless there is one."""
    spark = batch.sparkSession
    latest = batch.agg(F.max("timestamp")).first()[0]
    if latest is not None and int(latest) // sinks.DAY_S not in {d for d, _ in rollups(spark, history)}:
        roll_up(spark, history, int(latest) // sinks.DAY_S, batch_id, lookback_s)
