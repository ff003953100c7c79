"""Deployable streaming jobs: sources wired to operators and sinks.

Each ``start_*`` function starts checkpointed queries and returns them. A
raw stream comes from ``sources.read_positions`` / ``read_requests`` (a
message broker) or ``sources.read_files``; responses go to a table and,
when ``servers`` is given, to the response topics through the broker sink
(needs the connector package). ``trigger`` throttles a job, e.g.
``{"processingTime": "2 minutes"}``; tests use ``{"availableNow": True}``.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.operators import codecs, ingest, motion, tracks as trk, windows
from groundtrack.params import LOOKBACK_S, MOTION_TOP_N, RETAIN_S, SLIDE, VALID_CHOICES, WATERMARK, WINDOW
from groundtrack.streaming import keyed, live, rollup, sinks, snapshots, state, supervise


def publish(msgs: DataFrame, servers: str | None) -> None:
    """Send messages to the broker (batch write inside ``foreachBatch``), with
    ``part`` and ``n_parts`` as headers; no-op without ``servers``."""
    if servers:
        to_broker(msgs).write.format("kafka").option("kafka.bootstrap.servers", servers).option("includeHeaders", "true").save()


def to_broker(msgs: DataFrame) -> DataFrame:
    """Messages as a broker takes them."""
    headers = F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value")) for c in ("part", "n_parts")))
    return msgs.select("topic", "key", "value", headers.alias("headers"))


def _keep(df: DataFrame, batch_id: int, path: str) -> None:
    (df.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def start_positions(raw: DataFrame, root: str, archive_sat_id: str | None = None,
                    trigger: dict | None = None):
    """Parse position messages; archive accepted fixes (partitioned by day, with
    a roll-up of the past at each new day), keep rejected ones in a quarantine
    table, and maintain the latest-fix snapshot (each batch adds the objects that
    reported). Counts of rows and rejected rows come with the progress under
    ``positions``. Returns (archive query, snapshot query)."""
    plain = ingest.parse_positions(ingest.topic_filter(raw))
    parsed = supervise.observed(plain, "positions")

    def archive(b, i):
        b.persist()
        ok, bad = ingest.split(b)
        sinks.history_append(ok, i, os.path.join(root, "archive"), sat_id=archive_sat_id)
        rollup.advance(ok, i, os.path.join(root, "archive"))
        _keep(bad, i, os.path.join(root, "quarantine"))
        b.unpersist()

    q1 = sinks.start(parsed, os.path.join(root, "_ckpt_archive"), foreach_batch=archive, trigger=trigger, query_name="archive")
    ok, _ = ingest.split(plain)
    q2 = sinks.start(ok, os.path.join(root, "_ckpt_snapshot"), trigger=trigger, query_name="snapshot",
                     foreach_batch=lambda b, i: snapshots.write_delta(b, i, os.path.join(root, "snapshot")))
    return q1, q2


def start_requests(raw: DataFrame, root: str, servers: str | None = None,
                   trigger: dict | None = None, cell_deg: float | None = None,
                   lookback_s: int | None = None, required_satellites: int | None = None):
    """Answer observer requests from the archive written by
    ``start_positions`` (closest, overlap, motion); responses kept under
    ``root/responses`` and published when ``servers`` is set; requests that
    cannot be served are kept under ``root/rejected_requests``."""
    parsed = ingest.parse_requests(raw)
    checked = ingest.validate_requests(parsed)
    served = checked["reject_reason"].isNull() & checked["choice_id"].isin(*VALID_CHOICES)
    # counted as the rows pass; ``answer_requests`` checks again for itself
    reqs = supervise.observed(checked, "requests", n_answerable=served).drop("reject_reason")
    out = os.path.join(root, "responses")

    def answer(b, i):
        sent = state.answer_requests(b, i, os.path.join(root, "archive"), out, lookback_s=lookback_s,
                                     rejected=os.path.join(root, "rejected_requests"), cell_deg=cell_deg,
                                     required_satellites=required_satellites)
        if sent is not None:
            publish(sent, servers)

    return sinks.start(reqs, os.path.join(root, "_ckpt_requests"), foreach_batch=answer, trigger=trigger, query_name="requests")


def start_live(raw_positions: DataFrame, raw_requests: DataFrame, root: str, lookback_s: int, servers: str | None = None,
               trigger: dict | None = None, watermark: str = WATERMARK):
    """Closest-object requests answered from the position stream itself, by an
    event-time join of the two streams (``live``): no archive is written or
    read. An answer comes when the watermark has passed its request; kept under
    ``root/live_responses`` and published when ``servers`` is set."""
    ok, _ = ingest.split(ingest.parse_positions(ingest.topic_filter(raw_positions)))
    reqs, _ = ingest.split(ingest.validate_requests(ingest.parse_requests(raw_requests)))
    closest = live.closest_live(reqs.where(F.col("choice_id") == 3), ok, lookback_s, watermark)

    def send(b, i):
        b.persist()
        msgs = codecs.closest_response(b)
        _keep(msgs, i, os.path.join(root, "live_responses"))
        publish(msgs, servers)
        b.unpersist()

    return sinks.start(closest, os.path.join(root, "_ckpt_live"), foreach_batch=send, trigger=trigger, query_name="live")


def start_motion(raw: DataFrame, root: str, servers: str | None = None,
                 lookback_s: int = LOOKBACK_S, top_n: int = MOTION_TOP_N,
                 trigger: dict | None = None):
    """Motion vectors of the position stream (keyed state). Every vector is
    kept; the first ``top_n`` of each micro-batch also form one response
    message, as the original sends."""
    ok, _ = ingest.split(ingest.parse_positions(ingest.topic_filter(raw)))
    vec = state.motion_stream(ok, lookback_s)

    def emit(b, i):
        b.persist()
        _keep(b, i, os.path.join(root, "vectors"))
        top = motion.motion_top(b.withColumn("batch", F.lit(int(i))), "batch", top_n)
        msgs = codecs.motion_response(top)
        _keep(msgs, i, os.path.join(root, "motion_messages"))
        publish(msgs, servers)
        b.unpersist()

    return sinks.start(vec, os.path.join(root, "_ckpt_motion"), foreach_batch=emit, trigger=trigger, query_name="motion")


def start_tracks(raw: DataFrame, root: str, window: str = WINDOW, slide: str = SLIDE,
                 watermark: str = WATERMARK, trigger: dict | None = None, redraw: bool = True,
                 retain_s: int = RETAIN_S, final_only: bool = False, redraw_every_s: float = 0,
                 arrival_time: bool = False):
    """Sliding windows of the position stream; each batch's rows are kept
    under (hour of window end, ``batch_id``). Update mode (live windows,
    revised as fixes arrive) by default; ``final_only`` writes each window
    once, when the watermark has passed it (append mode, reduced per slot
    first). With ``redraw`` every micro-batch also rewrites ``root/map``:
    the tracks of the retained windows as GeoJSON plus their labels - the
    live map, a new version each time (``state.read_snapshot``), at most every
    ``redraw_every_s`` seconds; only a batch with rows starts that clock. It
    reads only the hour partitions the retention can reach. With
    ``arrival_time`` windows go by when a fix is read, as in the original."""
    ok, _ = ingest.split(ingest.parse_positions(ingest.topic_filter(raw)))
    if final_only or arrival_time:
        w = windows.sliding_positions(ok, window, slide, watermark=watermark, final_only=final_only, arrival_time=arrival_time)
    else:
        w = keyed.sliding_panes(ok, window, slide, watermark)
    win_path, map_path = os.path.join(root, "windows"), os.path.join(root, "map")

    drawn_at = [float("-inf")]

    def keep(b, i):
        b = b.persist()          # a stateful batch: evaluated once for all that follows
        try:
            (b.withColumn("end_hour", F.floor(F.col("window_end") / 3600).cast("bigint"))
             .withColumn("batch_id", F.lit(int(i))).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("end_hour", "batch_id").parquet(win_path))
            if not redraw or time.monotonic() - drawn_at[0] < redraw_every_s:
                return
            latest = b.agg(F.max("timestamp")).first()[0]
        finally:
            b.unpersist()
        if latest is None:
            return
        spark = b.sparkSession
        drawn_at[0] = time.monotonic()
        # an old batch never turns the clock back
        now = max(int(latest), read_windows(spark, root, since_s=int(latest)).agg(F.max("timestamp")).first()[0] or 0)
        recent = read_windows(spark, root, since_s=now - int(retain_s))
        tr = trk.tracks(recent, now, retain_s)
        drawn = trk.track_geojson(tr).join(
            trk.track_labels(tr, windows.track_retention(recent, now, retain_s)), "sat_id")
        state.write_snapshot(drawn.withColumn("batch_id", F.lit(int(i))), i, map_path)
        layers = trk.map_features(tr, windows.track_retention(recent, now, retain_s), F.unix_timestamp())
        state.write_snapshot(layers, i, os.path.join(root, "map_features"))

    return sinks.start(w, os.path.join(root, "_ckpt_tracks"), mode="append" if final_only else "update",
                       foreach_batch=keep, trigger=trigger, query_name="tracks")


WINDOWS = ("window_start bigint, window_end bigint, sat_id string, satname string, latitude double, longitude double, "
           "timestamp bigint, end_hour bigint, batch_id bigint")


def read_windows(spark, root: str, since_s: int | None = None) -> DataFrame:
    """Final value of every window written by ``start_tracks`` (the last
    update of each); ``since_s`` keeps windows ending at or after it and
    prunes the hour partitions before that."""
    u = spark.read.schema(WINDOWS).parquet(os.path.join(root, "windows"))
    if since_s is not None:
        u = u.where((F.col("end_hour") >= since_s // 3600) & (F.col("window_end") >= since_s))
    last = u.groupBy("window_start", "window_end", "sat_id", "satname").agg(
        F.max_by(F.struct("latitude", "longitude", "timestamp"), "batch_id").alias("v"))
    return last.select("window_start", "window_end", "sat_id", "satname", "v.*")
