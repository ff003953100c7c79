"""Stateful streaming operators (``keyed`` has those on the arbitrary-state API).

* ``latest_snapshot`` - the latest fix per object as a streaming aggregate;
  ``write_snapshot`` stores each version in its own folder and keeps a few.
* ``answer_requests`` - a request micro-batch answered from the fixes
  archived by the position query (the two queries share a table, not
  Python memory).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.operators import asof, codecs, ingest, latest, motion
from groundtrack.params import LOOKBACK_S
from groundtrack.streaming import rollup, sinks
from groundtrack.streaming.keyed import motion_stream  # noqa: F401 - one of the stateful operators

def last_revision(vectors: DataFrame) -> DataFrame:
    """The valid vector of each fix among all that were sent."""
    names = [c for c in vectors.columns if c not in ("sat_id", "timestamp", "seq", "revision", "batch_id")]
    return (vectors.groupBy("sat_id", "timestamp", "seq").agg(F.max_by(F.struct(*names), "revision").alias("v"))
            .select("sat_id", "timestamp", "seq", "v.*"))


def latest_snapshot(fixes: DataFrame) -> DataFrame:
    """Streaming (or batch) latest fix per object; run in complete mode, the
    state is one row per object."""
    return latest.latest_positions(fixes.select(
        "sat_id", "satname", "latitude", "longitude", "azimuth", "elevation", "timestamp", "seq"),
        two_step=False)


def _fs(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_snapshot(batch: DataFrame, batch_id: int, path: str, keep: int = 3) -> None:
    """Write one snapshot version to ``path/v=<batch_id>`` (overwrite, so a
    retried batch rewrites the same version) and drop all but the newest
    ``keep`` committed versions (metadata operations only)."""
    batch.write.mode("overwrite").parquet(os.path.join(path, f"v={int(batch_id):020d}"))
    spark = batch.sparkSession
    fs, root, jvm = _fs(spark, path)
    vs = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v="))
    for name in vs[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, name), True)


def read_snapshot(spark, path: str) -> DataFrame | None:
    """The newest committed snapshot version (one with ``_SUCCESS``)."""
    fs, root, jvm = _fs(spark, path)
    if not fs.exists(root):
        return None
    vs = sorted((s.getPath().getName() for s in fs.listStatus(root)
                 if s.getPath().getName().startswith("v=")), reverse=True)
    for name in vs:
        if fs.exists(jvm.org.apache.hadoop.fs.Path(jvm.org.apache.hadoop.fs.Path(root, name), "_SUCCESS")):
            return spark.read.parquet(os.path.join(path, name))
    return None


def _exists(spark, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def answer_requests(batch: DataFrame, batch_id: int, history: str, out: str,
                    lookback_s: int | None = None, motion_lookback_s: int = LOOKBACK_S,
                    rejected: str | None = None, cell_deg: float | None = None,
                    required_satellites: int | None = None) -> DataFrame | None:
    """Answer the requests of one micro-batch from the archived fixes; returns
    the messages written (read back), or None where there was none to write.

    Requests are validated and routed row by row; closest, overlap and
    motion requests are each answered with an as-of lookup. Of the archive
    only the days the batch reaches are read, and of those before the roll-up
    (``rollup``: last fix and last vector per object). The batch is
    kept while it is looked at, so it is computed once. Messages (``topic``,
    ``key``, ``part``, ``n_parts``, ``value``) are written under ``batch_id``
    (dynamic overwrite: a retried batch replaces its own output). Requests
    that cannot be served (invalid, exit, unknown) go to ``rejected`` with
    their reason when it is given; before any fix has been archived every
    request does (``no_positions``), so accepted and rejected ones add up.
    With ``required_satellites`` an overlap request is answered only where
    it sees that many objects.
    """
    spark = batch.sparkSession
    reqs = ingest.route_requests(ingest.validate_requests(batch)).persist()
    scratch = f"{out}_scratch/{int(batch_id)}"
    try:
        served = F.col("reject_reason").isNull() & F.col("action").isin("closest", "overlap", "motion_vector")
        empty = not _exists(spark, history)
        reason = F.coalesce(F.col("reject_reason"), F.when(~served, F.col("action")).otherwise(F.lit("no_positions")))
        if rejected:
            bad = reqs if empty else reqs.where(~served)
            (bad.withColumn("reject_reason", reason).withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejected))
        ok = reqs.where(served)
        n = lambda a: F.count_if(F.col("action") == a).alias(a)
        info = ok.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"),
                      n("closest"), n("overlap"), n("motion_vector")).first()
        if empty or info["lo"] is None:
            return None
        lo, hi = info["lo"], info["hi"]
        fixes = (rollup.cache(spark, history, lo, hi) if lookback_s is None
                 else sinks.read_history(spark, history, lo - int(lookback_s), hi))
        parts = []
        if info["closest"] or info["overlap"]:
            # looked up once for both kinds of answer
            seen = _stored(asof.asof_by_time(ok.where(F.col("action") != "motion_vector"), fixes, asof.POSITION_COLS, lookback_s),
                           f"{scratch}/seen")
        if info["closest"]:
            parts.append(codecs.closest_response(asof.closest_satellite(
                ok.where(F.col("action") == "closest"), fixes, lookback_s, cell_deg=cell_deg, seen=seen)))
        if info["overlap"]:
            pairs = asof.overlap_answers(ok.where(F.col("action") == "overlap"), fixes, lookback_s,
                                         required_satellites=required_satellites, seen=seen, total="n_pairs")
            parts.append(codecs.overlap_response(pairs, key="request_id", total="n_pairs"))
        if info["motion_vector"]:
            if lookback_s is None:
                vectors = rollup.vectors(spark, history, lo, hi, motion_lookback_s)
            else:
                since = lo - int(lookback_s) - int(motion_lookback_s)
                vectors = motion.motion_vectors(sinks.read_history(spark, history, since, hi), motion_lookback_s)
            # the lookup reads them several times
            vectors = _stored(vectors.select("sat_id", "timestamp", "seq", *asof.VECTOR_COLS), f"{scratch}/vectors")
            moves = _stored(asof.motion_answers(ok.where(F.col("action") == "motion_vector"), vectors, lookback_s), f"{scratch}/moves")
            parts.append(codecs.motion_request_response(moves))
        msgs = parts[0].select(MESSAGE)
        for m in parts[1:]:
            msgs = msgs.unionByName(m.select(MESSAGE))
        (msgs.withColumn("batch_id", F.lit(int(batch_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", MESSAGE_BLOCK)
         .option("compression", "zstd").partitionBy("batch_id").parquet(out))
        return read_messages(spark, out).where(F.col("batch_id") == int(batch_id))
    finally:
        reqs.unpersist()
        fs, path, _ = _fs(spark, scratch)
        fs.delete(path, True)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder beside the answers and read back: short plans
    behind it, and a lost executor costs no lookup. A retried batch overwrites it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Compressed bytes of a row group of messages: a reader takes up to 4,096 rows of
#: a group at once, and of long messages that would be tens of MB in every task.
MESSAGE_BLOCK = 256 << 10
MESSAGE = ["topic", "key", "part", "n_parts", "value"]


def read_messages(spark, path: str) -> DataFrame:
    """Messages kept by ``answer_requests``; keys stay text."""
    return spark.read.schema("topic string, key string, part bigint, n_parts bigint, value string, batch_id bigint").parquet(path)
