"""Checkpointed sinks.

Every query gets a checkpoint location under the shared folder named by
``spark.checkpoint.dir`` (offsets and state survive executor or driver
loss). ``foreachBatch`` bodies are DataFrame plans and idempotent by
``batch_id``: a re-run batch overwrites what its first attempt wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundtrack.functions.ordering import order_key
from groundtrack.params import HISTORY_SAT_ID
from groundtrack.schemas import POSITION


DAY_S = 86400
SPREAD_S = 21600            # an object's fixes of a day are written by several tasks
ARCHIVE = T.StructType([*POSITION.fields, T.StructField("seq", T.LongType()), T.StructField("topic", T.StringType()),
                        T.StructField("day", T.LongType()), T.StructField("batch_id", T.LongType())])
TAILS = "_last"             # beside the archive's folder: last fix per object, day and batch


def history_append(batch: DataFrame, batch_id: int, path: str,
                   sat_id: str | None = HISTORY_SAT_ID) -> None:
    """Append (accepted) fixes of one micro-batch to the history table.

    Parquet partitioned by ``day`` of the fix and ``batch_id``, so a read of a
    time range opens the folders of that range only; dynamic partition
    overwrite makes a retried batch replace its own files. Rows are dealt in
    ranges of day, object and time of day, so a busy day is written by several
    tasks, and a batch of many days gives about one file a day. Beside it
    (``path`` + ``_last``) goes the last fix per object and day: all that a
    later lookup needs of a day it does not read. ``sat_id`` limits the
    archive to one object as the original does; None archives all.
    """
    rows = batch if sat_id is None else batch.where(F.col("sat_id") == F.lit(sat_id))
    for f in ARCHIVE.fields[:-2]:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    rows = (rows.withColumns({"day": F.floor(F.col("timestamp") / DAY_S).cast("bigint"), "batch_id": F.lit(int(batch_id)).cast("bigint")})
            .select(ARCHIVE.names).repartitionByRange("day", "sat_id", F.floor(F.col("timestamp") / SPREAD_S)))
    rows.persist()
    try:
        names = [c for c in ARCHIVE.names if c not in ("sat_id", "day", "batch_id")]
        last = (rows.withColumn("_k", order_key()).groupBy("sat_id", "day", "batch_id")
                .agg(F.max_by(F.struct(*names), "_k").alias("l")))
        # the last fixes first: a reader between the two writes misses no day's last fix
        tasks = batch.sparkSession.sparkContext.defaultParallelism          # few rows, but a file for each day
        _write(last.select("sat_id", "day", "batch_id", "l.*").select(ARCHIVE.names).repartition(tasks, "day"), path + TAILS)
        _write(rows.sortWithinPartitions("day", "sat_id", "timestamp", "seq"), path)
    finally:
        rows.unpersist()


def _write(rows: DataFrame, path: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id").parquet(path))


def read_history(spark, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """The archived fixes, of ``lo <= timestamp <= hi`` where given (whole
    folders are skipped). The schema is fixed: ids stay text as they came."""
    df = spark.read.schema(ARCHIVE).parquet(path)
    for bound, op in ((lo, "__ge__"), (hi, "__le__")):
        if bound is not None:
            df = df.where(getattr(F.col("day"), op)(int(bound) // DAY_S) & getattr(F.col("timestamp"), op)(int(bound)))
    return df.drop("day", "batch_id")


def compact_history(spark, src: str, dst: str) -> None:
    """Rewrite an archive written per micro-batch (many small folders) into
    one partitioned by object and day, files sorted by time.

    A batch job: range partitioning on (sat_id, day, timestamp) spreads a
    busy object's days over many tasks instead of one per object; sorted
    files give tight per-row-group time statistics, so time-range reads skip
    row groups. Dynamic overwrite replaces only the (object, day) partitions
    present, so a re-run, or a run over a newer slice, is idempotent.
    """
    h = read_history(spark, src).drop("topic").withColumn("day", F.floor(F.col("timestamp") / 86400).cast("bigint"))
    (h.repartitionByRange("sat_id", "day", "timestamp")
     .sortWithinPartitions("sat_id", "day", "timestamp", "seq")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sat_id", "day").parquet(dst))


def read_history_range(spark, path: str, lo: int, hi: int, sat_ids=None) -> DataFrame:
    """Fixes with ``lo <= timestamp <= hi`` from a compacted archive: the day
    filter prunes partition folders, the timestamp filter is pushed to the
    parquet reader (row-group statistics)."""
    names = [f for f in ARCHIVE.fields if f.name not in ("topic", "day", "batch_id")]
    df = spark.read.schema(T.StructType([*names, T.StructField("day", T.LongType())])).parquet(path).where(
        F.col("day").between(lo // 86400, hi // 86400) & F.col("timestamp").between(lo, hi))
    if sat_ids is not None:
        df = df.where(F.col("sat_id").isin(list(sat_ids)))
    return df.drop("day")


def start(df: DataFrame, checkpoint: str, *, fmt: str | None = None, path: str | None = None,
          foreach_batch=None, mode: str = "append", trigger: dict | None = None,
          query_name: str | None = None):
    """Start a query with a checkpoint; ``trigger`` e.g. ``{"availableNow": True}``
    or ``{"processingTime": "2 minutes"}`` (the throttle of the original)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif fmt:
        w = w.format(fmt)
    return w.start(path) if path else w.start()
