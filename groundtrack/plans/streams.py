"""Registered streaming queries.

Each run stages raw records derived from the tables as ordered files in a
fresh folder under the shared checkpoint folder, runs the streaming plan
with an ``availableNow`` trigger (all staged data, in several micro-batches,
then stop) into a checkpointed sink, and returns the sink read back as a
batch DataFrame. Input arrives in time order and nothing is late, so each
result equals the batch result of the same operators (the SQL oracle
checks that); restarts, late rows and failures have their own tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.operators import codecs, ingest, tracks as trk, windows
from groundtrack.params import RETAIN_S, SAT_IDS
from groundtrack.schemas import MOTION_ITEM, OVERLAP_ITEM
from groundtrack.session import checkpoint_path
from groundtrack.sources import fixtures as fx
from groundtrack.streaming import jobs, keyed, live, records, rollup, sinks, snapshots, sources, state, supervise

CHUNKS = 4          # staged files = micro-batches (maxFilesPerTrigger = 1)


def run_dir(spark: SparkSession, name: str) -> str:
    return checkpoint_path(spark, f"runs/{name}-{uuid.uuid4().hex[:12]}")


def stage(raw: DataFrame, path: str, chunks: int = CHUNKS, order: str = "offset") -> str:
    """Write raw records as files of consecutive ``order`` ranges that a
    file stream reads in that order (``staged_stream`` groups them into
    about ``chunks`` micro-batches).

    One range-partitioned write with as many files for each micro-batch as the
    input has partitions (so staging, and every micro-batch, is as parallel as
    the input: a file of one row group is read by one task), then increasing
    modification times on the files (metadata operations only). Where the
    file system cannot set times (some object stores), ``chunks`` slices
    are written one after another instead, so their creation times follow
    the order.
    """
    files = chunks * max(1, raw.rdd.getNumPartitions())
    (raw.repartitionByRange(files, order).sortWithinPartitions(order)
     .write.mode("overwrite").parquet(path))
    spark = raw.sparkSession
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(st.getPath().toString() for st in fs.listStatus(root)
                   if st.getPath().getName().startswith("part-"))
    base = (int(jvm.java.lang.System.currentTimeMillis()) // 1000 - 10 * (len(files) + 1)) * 1000
    try:
        for i, f in enumerate(files):      # part-00000 holds the lowest range
            fs.setTimes(jvm.org.apache.hadoop.fs.Path(f), base + 10_000 * i, -1)
        # some file systems take the call and do nothing
        kept = all(fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(f)).getModificationTime() == base + 10_000 * i
                   for i, f in enumerate(files))
    except Exception:  # noqa: BLE001 - file system without settable times
        kept = False
    if not kept:
        staged = spark.read.parquet(path)
        seq_path = path.rstrip("/") + "_seq"
        bounds = staged.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
        if bounds["lo"] is None:           # nothing to order
            return path
        lo, hi = int(bounds["lo"]), int(bounds["hi"])
        step = (hi - lo) // chunks + 1
        for i in range(chunks):
            (staged.where((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
             .write.mode("append").parquet(seq_path))
        return seq_path
    return path


def staged_stream(spark: SparkSession, path: str, chunks: int = CHUNKS) -> DataFrame:
    """A file stream over a ``stage`` folder: about ``chunks`` micro-batches
    of consecutive files."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = sum(1 for st in fs.listStatus(root) if st.getPath().getName().startswith("part-"))
    return sources.read_files(spark, path, max_files_per_trigger=max(1, -(-n // chunks)))


def encode_raw(fixes: DataFrame) -> DataFrame:
    """Fixes as raw position records (JSON value, per-object topic, offset)."""
    return codecs.encode_positions(fixes, offset="seq").select("value", "topic", "offset")


def _positions_stream(spark, folder):
    raw = staged_stream(spark, folder)
    ok, _ = ingest.split(ingest.parse_positions(ingest.topic_filter(raw)))
    return ok


def _drain(q):
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def scan_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = run_dir(spark, "scan_positions")
    raw = fx.raw_positions(spark, sf_dir).unionByName(fx.raw_requests(spark, sf_dir))
    src = stage(raw, f"{d}/in")
    s = ingest.parse_positions(ingest.topic_filter(staged_stream(spark, src)))
    _drain(sinks.start(s, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"availableNow": True}))
    return spark.read.parquet(f"{d}/out")


def scan_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = run_dir(spark, "scan_requests")
    src = stage(fx.raw_requests(spark, sf_dir), f"{d}/in")
    raw = staged_stream(spark, src)
    s = ingest.route_requests(ingest.validate_requests(ingest.parse_requests(raw)))
    _drain(sinks.start(s, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"availableNow": True}))
    return spark.read.parquet(f"{d}/out")


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = run_dir(spark, "history_append")
    s = _positions_stream(spark, stage(encode_raw(fx.ticks(spark, sf_dir)), f"{d}/in"))
    _drain(sinks.start(s, f"{d}/ckpt", foreach_batch=lambda b, i: sinks.history_append(b, i, f"{d}/hist"),
                       trigger={"availableNow": True}))
    return trk.history_path(sinks.read_history(spark, f"{d}/hist"))


def motion_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = run_dir(spark, "motion_stream")
    s = state.motion_stream(_positions_stream(spark, stage(encode_raw(fx.ticks(spark, sf_dir)), f"{d}/in")))
    _drain(sinks.start(s, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"availableNow": True}))
    return spark.read.parquet(f"{d}/out").drop("revision")


def motion_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input out of order: within blocks of 40 polls the second half comes
    first. The last revision of each vector equals the batch result."""
    d = run_dir(spark, "motion_stream_late")
    half = F.expr("(offset div 100) % 2")
    raw = encode_raw(fx.ticks(spark, sf_dir)).withColumn("arrival", F.col("offset") + F.when(half == 0, 100).otherwise(-100))
    src = stage(raw, f"{d}/in", order="arrival")
    s = state.motion_stream(_positions_stream(spark, src), watermark="1 day")
    _drain(sinks.start(s, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"availableNow": True}))
    return state.last_revision(spark.read.parquet(f"{d}/out"))


def snapshot_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = run_dir(spark, "snapshot_stream")
    s = state.latest_snapshot(_positions_stream(spark, stage(encode_raw(fx.irregular(spark, sf_dir)), f"{d}/in")))
    _drain(sinks.start(s, f"{d}/ckpt", mode="complete",
                       foreach_batch=lambda b, i: state.write_snapshot(b, i, f"{d}/snap"),
                       trigger={"availableNow": True}))
    return state.read_snapshot(spark, f"{d}/snap")


def closest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries: positions archive every fix; requests are answered per
    micro-batch from that archive. Returns the closest-object answers
    (objects on the response topic; overlap lists are arrays there)."""
    d = run_dir(spark, "closest_stream")
    pos_src = stage(encode_raw(fx.irregular(spark, sf_dir)), f"{d}/pos")
    req_src = stage(fx.raw_requests(spark, sf_dir), f"{d}/req")
    pos = _positions_stream(spark, pos_src)
    _drain(sinks.start(pos, f"{d}/ckpt_pos", trigger={"availableNow": True},
                       foreach_batch=lambda b, i: sinks.history_append(b, i, f"{d}/hist", sat_id=None)))
    req = ingest.parse_requests(staged_stream(spark, req_src))
    _drain(sinks.start(req, f"{d}/ckpt_req", trigger={"availableNow": True},
                       foreach_batch=lambda b, i: state.answer_requests(b, i, f"{d}/hist", f"{d}/resp")))
    resp = state.read_messages(spark, f"{d}/resp").drop("batch_id")
    return codecs.decode_responses(resp.where(F.col("topic") == "observer_response")
                                   .where(F.col("value").startswith("{")))


def answers_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap answers of 60 objects (1,770 pairs, more than one message
    holds) through the request job and the decoder: one request per poll."""
    d = run_dir(spark, "answers_whole")
    fixes = fx.ticks_n(spark, sf_dir, 60)
    sinks.history_append(fixes, 0, f"{d}/hist", sat_id=None)
    reqs = fixes.select("timestamp").distinct().select(
        F.concat(F.lit("r"), F.col("timestamp").cast("string")).alias("request_id"), F.lit(0.0).alias("obs_latitude"),
        F.lit(0.0).alias("obs_longitude"), F.lit(0.0).alias("altitude"), "timestamp", F.lit(2).alias("choice_id"))
    msgs = state.answer_requests(reqs, 0, f"{d}/hist", f"{d}/resp")
    items = codecs.decode_responses(msgs.select("key", "part", "n_parts", "value"), OVERLAP_ITEM)
    return items.groupBy("key").agg(
        F.max("n_parts").alias("n_parts"), F.count_distinct("part").alias("parts_seen"), F.count("satname1").alias("n_pairs"),
        F.count_if("overlap").alias("n_overlap"), F.round(F.max("distance_km"), 2).alias("farthest_km"),
        F.count("reject_reason").alias("n_rejected"))


MIXED_IDS = ("7", "007", "10", "9", "A1")


def closest_mixed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that look alike as numbers, two partitions with equal offsets: fixes
    through the archive, every request answered on its own."""
    d = run_dir(spark, "closest_mixed_ids")
    ids = F.create_map(*[F.lit(x) for pair in zip(SAT_IDS, MIXED_IDS) for x in pair])
    fixes = fx.irregular(spark, sf_dir).withColumn("sat_id", ids[F.col("sat_id")])
    sinks.history_append(fixes, 0, f"{d}/hist", sat_id=None)
    raw = fx.raw_requests(spark, sf_dir).withColumns({
        "partition": (F.col("offset") % 2).cast("int"), "offset": F.expr("offset div 2")})
    state.answer_requests(ingest.parse_requests(raw), 0, f"{d}/hist", f"{d}/resp")
    closest = state.read_messages(spark, f"{d}/resp").where(F.col("topic") == "observer_response").where(F.col("value").startswith("{"))
    return codecs.decode_responses(closest.select("key", "value")).select("key", "sat_id", "distance_km", "timestamp")


def sliding_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows on event time with a watermark, update mode; each
    batch's updates are kept under its ``batch_id`` and the final value of a
    window is its last update."""
    d = run_dir(spark, "sliding_stream")
    src = stage(encode_raw(fx.irregular(spark, sf_dir)), f"{d}/in")
    s = windows.sliding_positions(_positions_stream(spark, src), watermark="10 minutes")

    def keep(b, i):
        b.withColumn("batch_id", F.lit(int(i))).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{d}/out")

    _drain(sinks.start(s, f"{d}/ckpt", mode="update", foreach_batch=keep, trigger={"availableNow": True}))
    u = spark.read.parquet(f"{d}/out")
    last = u.groupBy("window_start", "window_end", "sat_id", "satname").agg(
        F.max_by(F.struct("latitude", "longitude", "timestamp"), "batch_id").alias("v"))
    return last.select("window_start", "window_end", "sat_id", "satname", "v.*")


def stream_batch_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks from the streaming windows against tracks from the batch
    windows over the same fixes: one row per object with both point counts
    and whether the two paths are identical."""
    f = fx.ticks(spark, sf_dir)
    now = windows.data_now(f)
    batch = trk.tracks(windows.sliding_positions(f), now, RETAIN_S)
    d = run_dir(spark, "parity")
    src = stage(encode_raw(f), f"{d}/in")
    s = windows.sliding_positions(_positions_stream(spark, src), watermark="10 minutes")

    def keep(b, i):
        b.withColumn("batch_id", F.lit(int(i))).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{d}/out")

    _drain(sinks.start(s, f"{d}/ckpt", mode="update", foreach_batch=keep, trigger={"availableNow": True}))
    u = spark.read.parquet(f"{d}/out")
    w = u.groupBy("window_start", "window_end", "sat_id", "satname").agg(
        F.max_by(F.struct("latitude", "longitude", "timestamp"), "batch_id").alias("v")).select(
        "window_start", "window_end", "sat_id", "satname", "v.*")
    stream = trk.tracks(w, now, RETAIN_S)
    j = batch.alias("b").join(stream.alias("s"), "sat_id", "full_outer")
    return j.select("sat_id", F.col("b.n_points").cast("bigint").alias("batch_points"),
                    F.col("s.n_points").cast("bigint").alias("stream_points"),
                    (F.col("b.path") == F.col("s.path")).alias("same_path"))


#: Rows that end a staged stream: so much later that the watermark passes all others.
END_S = 86400


def _ended_fixes(fixes: DataFrame) -> DataFrame:
    """Fixes and one of an object ``0``, a day after the last."""
    last = fixes.agg((F.max("timestamp") + END_S).alias("timestamp"), (F.max("seq") + 1).alias("seq"))
    return fixes.unionByName(last.select(F.lit("0").alias("sat_id"), F.lit("Sat 0").alias("satname"),
                                         *[F.lit(0.0).alias(c) for c in ("latitude", "longitude", "azimuth", "elevation")], "timestamp", "seq"))


def _ended_requests(reqs: DataFrame) -> DataFrame:
    """Request messages and one a day after the last."""
    last = reqs.agg((F.max("request_id") + 1).alias("request_id"), (F.max("timestamp") + END_S).alias("timestamp"))
    all_ = reqs.unionByName(last.select("request_id", *[F.lit(0.0).alias(c) for c in ("obs_latitude", "obs_longitude", "altitude")], "timestamp",
                                        F.lit(3).alias("choice_id")))
    return codecs.encode_requests(all_).select("value", "topic", F.col("key").cast("bigint").alias("offset"))


def _two_streams(spark: SparkSession, sf_dir: str, d: str) -> tuple[DataFrame, DataFrame]:
    """(closest requests, fixes) as streams that end."""
    pos = stage(encode_raw(_ended_fixes(fx.irregular(spark, sf_dir))), f"{d}/pos")
    req = stage(_ended_requests(fx.requests(spark, sf_dir)), f"{d}/req")
    return ingest.parse_requests(staged_stream(spark, req)).where("choice_id = 3"), _positions_stream(spark, pos)


def asof_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join of the two streams themselves, with an hour of look-back."""
    d = run_dir(spark, "asof_live")
    rows = live.asof_live(*_two_streams(spark, sf_dir, d), 3600, spread=2)
    _drain(sinks.start(rows, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"availableNow": True}))
    return spark.read.parquet(f"{d}/out").drop("request_time")


def closest_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closest objects from the two streams themselves: join, as-of pick and
    arg-min chained in one query."""
    d = run_dir(spark, "closest_live")
    rows = live.closest_live(*_two_streams(spark, sf_dir, d), 3600, spread=2)
    _drain(sinks.start(rows, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"availableNow": True}))
    return spark.read.parquet(f"{d}/out")


def sliding_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live windows from shared slots; the final value of a window is its last update."""
    d = run_dir(spark, "sliding_panes")
    src = stage(encode_raw(fx.irregular(spark, sf_dir)), f"{d}/in")
    s = keyed.sliding_panes(_positions_stream(spark, src))

    def keep(b, i):
        b.withColumn("batch_id", F.lit(int(i))).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{d}/out")

    _drain(sinks.start(s, f"{d}/ckpt", mode="update", foreach_batch=keep, trigger={"availableNow": True}))
    last = spark.read.parquet(f"{d}/out").groupBy("window_start", "window_end", "sat_id", "satname").agg(
        F.max_by(F.struct("latitude", "longitude", "timestamp"), "batch_id").alias("v"))
    return last.select("window_start", "window_end", "sat_id", "satname", "v.*")


def snapshot_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest fixes merged from what each micro-batch added."""
    d = run_dir(spark, "snapshot_deltas")
    s = _positions_stream(spark, stage(encode_raw(fx.irregular(spark, sf_dir)), f"{d}/in"))
    _drain(sinks.start(s, f"{d}/ckpt", trigger={"availableNow": True},
                       foreach_batch=lambda b, i: snapshots.write_delta(b, i, f"{d}/snap", max_deltas=2)))
    return snapshots.read_latest(spark, f"{d}/snap")


def motion_answers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Motion requests answered from the archive's roll-ups and the days that
    the requests reach: two queries over one archive."""
    d = run_dir(spark, "motion_answers_stream")
    pos = _positions_stream(spark, stage(encode_raw(fx.irregular(spark, sf_dir)), f"{d}/pos"))

    def archive(b, i):
        sinks.history_append(b, i, f"{d}/hist", sat_id=None)
        rollup.advance(b, i, f"{d}/hist")

    _drain(sinks.start(pos, f"{d}/ckpt_pos", trigger={"availableNow": True}, foreach_batch=archive))
    req = ingest.parse_requests(staged_stream(spark, stage(fx.raw_requests(spark, sf_dir), f"{d}/req"))).where("choice_id = 1")
    _drain(sinks.start(req, f"{d}/ckpt_req", trigger={"availableNow": True},
                       foreach_batch=lambda b, i: state.answer_requests(b, i, f"{d}/hist", f"{d}/resp")))
    items = codecs.decode_responses(state.read_messages(spark, f"{d}/resp").select("key", "value"), MOTION_ITEM)
    return items.select(F.col("key").alias("request_id"), "sat_id", "satname", "velocity_kmph", F.col("direction.delta_latitude").alias("delta_latitude"),
                        F.col("direction.delta_longitude").alias("delta_longitude"), F.col("timestamp").alias("vector_ts"), "reject_reason")


def scan_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position and request messages written to a record log by one stream and
    read from it by another, by topic pattern and a few thousand records at a
    time, so that micro-batches end inside its files."""
    d = run_dir(spark, "scan_log")
    raw = fx.raw_positions(spark, sf_dir).unionByName(fx.raw_requests(spark, sf_dir))
    records.register(spark)
    src = staged_stream(spark, stage(raw, f"{d}/in")).select("topic", "value")
    _drain(src.writeStream.format(records.NAME).option("checkpointLocation", f"{d}/ckpt_log").option("partitions", 2)
           .trigger(availableNow=True).start(f"{d}/log"))
    most = max(1, raw.count() // 5)
    log = records.read_log(spark, f"{d}/log", subscribePattern=sources.POSITION_TOPICS, maxRecordsPerBatch=most, progress=f"{d}/progress")
    parsed = ingest.parse_positions(log).drop("seq")
    q = sinks.start(parsed, f"{d}/ckpt", fmt="parquet", path=f"{d}/out", trigger={"processingTime": "0 seconds"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{d}/out")


def supervised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the position job and the request job saw, rejected and can answer,
    as their supervisor counted it batch by batch."""
    d = run_dir(spark, "supervised_counts")
    pos = staged_stream(spark, stage(fx.raw_positions(spark, sf_dir), f"{d}/pos"))
    req = staged_stream(spark, stage(fx.raw_requests(spark, sf_dir), f"{d}/req"))
    now = {"availableNow": True}
    with supervise.supervised(spark) as seen:
        for q in jobs.start_positions(pos, f"{d}/root", trigger=now):
            _drain(q)
        _drain(jobs.start_requests(req, f"{d}/root", trigger=now))
    rows = [(name, t.get("n_rows", 0), t.get("n_rejected", 0), t.get("n_answerable"), t.get("late_rows", 0), t.get("failures", 0))
            for name, t in seen.totals().items() if name in ("archive", "requests")]
    return spark.createDataFrame(rows, "query string, n_rows bigint, n_rejected bigint, n_answerable bigint, n_late bigint, n_failures bigint")


STREAM_QUERIES = {
    "asof_live": asof_live,
    "closest_live": closest_live,
    "sliding_panes": sliding_panes,
    "snapshot_deltas": snapshot_deltas,
    "motion_answers_stream": motion_answers_stream,
    "scan_log": scan_log,
    "supervised_counts": supervised_counts,
    "scan_positions": scan_positions,
    "scan_requests": scan_requests,
    "history_append": history_append,
    "motion_stream": motion_stream,
    "motion_stream_late": motion_stream_late,
    "answers_whole": answers_whole,
    "closest_mixed_ids": closest_mixed_ids,
    "snapshot_stream": snapshot_stream,
    "closest_stream": closest_stream,
    "sliding_stream": sliding_stream,
    "stream_batch_parity": stream_batch_parity,
}
