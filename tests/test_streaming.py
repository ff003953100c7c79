"""Stream = batch parity, restart from a checkpoint, late rows, idempotent sinks."""

import os

from pyspark.sql import functions as F

from groundtrack.schemas import OVERLAP_ITEM
from groundtrack.operators import codecs, ingest, motion, windows
from groundtrack.plans import streams
from groundtrack.sources import fixtures as fx
from groundtrack.streaming import sinks, snapshots, sources, state

from conftest import SF_SMALL

POS = ("sat_id string, satname string, latitude double, longitude double, azimuth double, "
       "elevation double, timestamp bigint, seq bigint")
VEC = ["sat_id", "timestamp", "seq", "prev_timestamp", "velocity_kmph", "delta_latitude", "delta_longitude"]


def _positions(spark, folder):
    ok, _ = ingest.split(ingest.parse_positions(sources.read_files(spark, folder, max_files_per_trigger=1)))
    return ok


def _write_file(spark, rows, folder):
    df = spark.createDataFrame([(s, f"Sat {s}", la, lo, 0.0, 0.0, t, q) for s, la, lo, t, q in rows], POS)
    streams.encode_raw(df).coalesce(1).write.mode("append").parquet(folder)


def test_motion_stream_equals_batch(spark, scratch):
    f = fx.ticks(spark, SF_SMALL)
    src = streams.stage(streams.encode_raw(f), f"{scratch}/in")
    q = sinks.start(state.motion_stream(_positions(spark, src)), f"{scratch}/ck",
                    fmt="parquet", path=f"{scratch}/out", trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/out").select(*VEC).collect())
    want = sorted(tuple(r) for r in motion.motion_vectors(f).select(*VEC).collect())
    assert len(got) == len(want) > 0
    assert got == want          # same Spark expression: bit-identical values


def test_motion_stream_restarts_from_checkpoint(spark, scratch):
    f = fx.ticks(spark, SF_SMALL)
    raw = streams.encode_raw(f)
    half = f.agg(F.max("seq")).first()[0] // 2
    raw.where(F.col("offset") <= half).coalesce(1).write.parquet(f"{scratch}/in")
    run = lambda: sinks.start(state.motion_stream(_positions(spark, f"{scratch}/in")), f"{scratch}/ck",
                              fmt="parquet", path=f"{scratch}/out", trigger={"availableNow": True})
    run().awaitTermination()
    first = spark.read.parquet(f"{scratch}/out").count()
    raw.where(F.col("offset") > half).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    run().awaitTermination()       # new query, same checkpoint: offsets and state resume
    got = spark.read.parquet(f"{scratch}/out")
    assert 0 < first < got.count() == motion.motion_vectors(f).count()
    assert got.groupBy("sat_id", "seq").count().where("count > 1").count() == 0


def test_motion_stream_answers_late_fix(spark, scratch):
    _write_file(spark, [("1", 0.0, 0.0, 1000, 1), ("1", 0.1, 0.0, 1060, 2)], f"{scratch}/in")
    _write_file(spark, [("1", 0.2, 0.0, 1030, 3), ("1", 0.3, 0.0, 1120, 4)], f"{scratch}/in")
    q = sinks.start(state.motion_stream(_positions(spark, f"{scratch}/in"), watermark="1 hour"),
                    f"{scratch}/ck", fmt="parquet", path=f"{scratch}/out", trigger={"availableNow": True})
    q.awaitTermination()
    r = {x.seq: x.prev_timestamp for x in spark.read.parquet(f"{scratch}/out").collect()}
    assert r == {2: 1000, 3: 1000, 4: 1000}   # oldest within 300 s


def test_late_fix_revises_later_vectors(spark, scratch):
    rows = [("1", 0.0, 0.0, 1200, 1), ("1", 0.1, 0.0, 1400, 2), ("1", 0.2, 0.0, 1150, 3)]
    _write_file(spark, rows[:2], f"{scratch}/in")
    _write_file(spark, rows[2:], f"{scratch}/in")
    q = sinks.start(state.motion_stream(_positions(spark, f"{scratch}/in"), watermark="1 hour"),
                    f"{scratch}/ck", fmt="parquet", path=f"{scratch}/out", trigger={"availableNow": True})
    q.awaitTermination()
    last = {x.seq: x.prev_timestamp for x in state.last_revision(spark.read.parquet(f"{scratch}/out")).collect()}
    assert last == {1: 1150, 2: 1150}


def test_null_offsets_stay_null(spark):
    rows = [("1", "Sat 1", 0.0, 0.0, 0.0, 0.0, 1000, None), ("1", "Sat 1", 0.1, 0.0, 0.0, 0.0, 1000, 5), ("1", "Sat 1", 0.2, 0.0, 0.0, 0.0, 1060, None)]
    got = {(r.timestamp, r.seq): r.prev_timestamp for r in motion.motion_vectors(spark.createDataFrame(rows, POS)).collect()}
    assert got == {(1000, 5): 1000, (1060, None): 1000}


REQS = "request_id string, obs_latitude double, obs_longitude double, altitude double, timestamp long, choice_id int"


def test_requests_before_any_fix_are_accounted_for(spark, scratch, monkeypatch):
    from groundtrack.streaming import jobs
    sent = []
    monkeypatch.setattr(jobs, "publish", lambda msgs, servers: sent.append(msgs))
    raw = spark.createDataFrame([('{"choice_id": 3, "obs_latitude": 1.0, "obs_longitude": 2.0, "timestamp": 5}', "observer_location", 0, 0),
                                 ('{"choice_id": 3, "obs_latitude": 1.0, "obs_longitude": 2.0}', "observer_location", 1, 0)],
                                "value string, topic string, partition int, offset long")
    raw.write.parquet(f"{scratch}/in")
    q = jobs.start_requests(sources.read_files(spark, f"{scratch}/in"), scratch, servers="nowhere:1", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None and sent == []
    rej = {r.request_id: r.reject_reason for r in spark.read.parquet(f"{scratch}/rejected_requests").collect()}
    assert rej == {"observer_location:0:0": "no_positions", "observer_location:1:0": "missing_timestamp"}


def test_gate_ids_and_old_fixes_in_the_live_path(spark, scratch):
    """A fix of another day is still seen, ids stay text, the gate holds."""
    rows = [(i, f"Sat {i}", float(k), 0.0, 0.0, 0.0, 1_000_000, k) for k, i in enumerate(("7", "007", "10"))]
    sinks.history_append(spark.createDataFrame(rows, POS), 0, f"{scratch}/hist", sat_id=None)
    reqs = spark.createDataFrame([("a", 0.0, 0.0, 0.0, 9_000_000, 3), ("b", 0.0, 0.0, 0.0, 9_000_000, 2)], REQS)
    msgs = state.answer_requests(reqs, 0, f"{scratch}/hist", f"{scratch}/r1", required_satellites=3).collect()
    assert {m.key for m in msgs} == {"a", "b"} and '"sat_id":"7"' in [m.value for m in msgs if m.key == "a"][0]
    assert [len(codecs.decode_responses(spark.createDataFrame([m]), OVERLAP_ITEM).collect()) for m in msgs if m.key == "b"] == [3]
    msgs = state.answer_requests(reqs, 0, f"{scratch}/hist", f"{scratch}/r2", required_satellites=4).collect()
    assert {m.key for m in msgs} == {"a"}
    assert {r.sat_id for r in sinks.read_history(spark, f"{scratch}/hist").collect()} == {"7", "007", "10"}


def test_time_range_prunes_archive_folders(spark, scratch):
    sinks.history_append(fx.irregular(spark, SF_SMALL), 0, f"{scratch}/hist", sat_id=None)
    plan = sinks.read_history(spark, f"{scratch}/hist", 10 ** 9, 2 * 10 ** 9)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_decoder_keeps_junk_with_a_reason(spark):
    rows = [("k", "not json"), ("k", "[]"), ("k", None), ("k", '{"sat_id":"1","distance_km":2.0}')]
    got = [(r.sat_id, r.reject_reason) for r in codecs.decode_responses(spark.createDataFrame(rows, "key string, value string")).collect()]
    assert got == [(None, "unparseable"), (None, "empty"), (None, "unparseable"), ("1", None)]


def test_incomplete_answers_are_noticed(spark):
    from groundtrack.streaming import jobs
    pairs = spark.range(2500).select(F.lit("q").alias("request_id"), F.col("id").cast("string").alias("sat_id1"), F.lit("x").alias("sat_id2"),
                                     F.lit(1).cast("long").alias("timestamp"), F.lit("a").alias("satname1"), F.lit("b").alias("satname2"), F.lit(1.0).alias("distance_km"),
                                     F.lit(True).alias("overlap"), F.lit(1.0).alias("overlap_km"), *[F.lit(0.0).alias(c) for c in ("lat1", "lon1", "lat2", "lon2")])
    msgs = codecs.overlap_response(pairs, key="request_id")
    assert [r.whole for r in codecs.whole_answers(msgs).collect()] == [True]
    assert [r.whole for r in codecs.whole_answers(msgs.where("part > 0")).collect()] == [False]
    heads = {h.key: bytes(h.value) for h in jobs.to_broker(msgs).first().headers}
    assert int(heads["n_parts"]) >= 2500 // codecs.MAX_ITEMS and codecs.decode_responses(msgs, OVERLAP_ITEM).count() == 2500


def test_sliding_drops_row_behind_watermark(spark, scratch):
    t0 = 1_800_000_000
    _write_file(spark, [("1", 0.0, 0.0, t0, 1)], f"{scratch}/in")
    _write_file(spark, [("1", 1.0, 0.0, t0 + 7200, 2)], f"{scratch}/in")     # watermark moves
    _write_file(spark, [("1", 2.0, 0.0, t0 + 7300, 3)], f"{scratch}/in")     # one batch in between
    _write_file(spark, [("1", 9.0, 0.0, t0 + 60, 4)], f"{scratch}/in")       # late
    s = windows.sliding_positions(_positions(spark, f"{scratch}/in"), watermark="10 minutes")
    out = f"{scratch}/out"

    def keep(b, i):
        b.withColumn("batch_id", F.lit(i)).write.mode("append").parquet(out)

    sinks.start(s, f"{scratch}/ck", mode="update", foreach_batch=keep,
                trigger={"availableNow": True}).awaitTermination()
    u = spark.read.parquet(out)
    assert u.where(F.col("latitude") == 9.0).count() == 0
    assert u.where(F.col("latitude") == 2.0).count() == 15


def test_history_append_is_idempotent(spark, scratch):
    f = fx.ticks(spark, SF_SMALL)
    sinks.history_append(f, 7, f"{scratch}/h")
    sinks.history_append(f, 7, f"{scratch}/h")        # retried batch
    sinks.history_append(f.where("seq < 10"), 8, f"{scratch}/h")
    h = sinks.read_history(spark, f"{scratch}/h")
    assert h.count() == f.where("sat_id = '49810'").count() + 2
    assert any(d.startswith("day=") for d in os.listdir(f"{scratch}/h"))


def test_snapshot_versions(spark, scratch):
    f = fx.irregular(spark, SF_SMALL)
    for i in range(5):
        state.write_snapshot(state.latest_snapshot(f.where(F.col("seq") <= 100 * (i + 1))), i, f"{scratch}/s", keep=2)
    assert len([n for n in os.listdir(f"{scratch}/s") if n.startswith("v=")]) == 2
    snap = state.read_snapshot(spark, f"{scratch}/s")
    assert snap.agg(F.max("seq")).first()[0] <= 500 and snap.count() == 5


def test_stream_batch_parity(spark):
    r = streams.stream_batch_parity(spark, SF_SMALL).collect()
    assert r and all(x.same_path and x.batch_points == x.stream_points for x in r)


def test_closest_stream_equals_batch(spark):
    import __spark_entry__ as E
    s = streams.closest_stream(spark, SF_SMALL).drop("topic").withColumnRenamed("key", "rid")
    b = E.queries()["closest_satellite"](spark, SF_SMALL)
    got = sorted((int(r.rid), r.sat_id, r.distance_km) for r in s.collect())
    want = sorted((r.request_id, r.sat_id, r.distance_km) for r in b.collect())
    assert got == want and got


def test_request_stream_answers_all_kinds(spark, scratch):
    """Closest, overlap and motion requests of a stream, answered from the
    archive, equal the batch answers."""
    import __spark_entry__ as E
    from groundtrack.schemas import MOTION_ITEM, OVERLAP_ITEM
    from pyspark.sql.types import ArrayType
    f = fx.irregular(spark, SF_SMALL)
    sinks.history_append(f, 0, f"{scratch}/hist", sat_id=None)
    src = streams.stage(fx.raw_requests(spark, SF_SMALL), f"{scratch}/req")
    req = ingest.parse_requests(sources.read_files(spark, src, max_files_per_trigger=1))
    sinks.start(req, f"{scratch}/ck", trigger={"availableNow": True},
                foreach_batch=lambda b, i: state.answer_requests(b, i, f"{scratch}/hist", f"{scratch}/resp")
                ).awaitTermination()
    resp = spark.read.parquet(f"{scratch}/resp")
    ov = (resp.where(F.col("value").startswith("[") & (F.col("topic") == "observer_response"))
          .select(F.col("key").cast("long").alias("request_id"),
                  F.explode(F.from_json("value", ArrayType(OVERLAP_ITEM))).alias("i")))
    got = sorted((r.request_id, r.i.satname1, r.i.satname2, r.i.distance_km) for r in ov.collect())
    want = sorted((r.request_id, r.satname1, r.satname2, r.distance_km)
                  for r in E.queries()["overlap_answers"](spark, SF_SMALL).collect())
    assert got == want
    mv = (resp.where(F.col("topic") == "motion_vector_response")
          .select(F.col("key").cast("long").alias("request_id"),
                  F.explode(F.from_json("value", ArrayType(MOTION_ITEM))).alias("i")))
    got = sorted((r.request_id, r.i.sat_id, r.i.velocity_kmph) for r in mv.collect())
    want = sorted((r.request_id, r.sat_id, r.velocity_kmph)
                  for r in E.queries()["motion_answers"](spark, SF_SMALL).collect())
    assert got == want and got


def test_jobs_end_to_end(spark, scratch):
    """Position, request, motion and track jobs over file sources."""
    import __spark_entry__ as E
    from groundtrack.operators import tracks as trk
    from groundtrack.streaming import jobs
    f = fx.irregular(spark, SF_SMALL)
    raw = streams.encode_raw(f).unionByName(
        spark.createDataFrame([("junk", "satellite-1", 10 ** 9)], "value string, topic string, offset long"))
    pos = streams.stage(raw, f"{scratch}/pos")
    req = streams.stage(fx.raw_requests(spark, SF_SMALL), f"{scratch}/req")
    src = lambda p: sources.read_files(spark, p, max_files_per_trigger=1)
    now = {"availableNow": True}
    for q in jobs.start_positions(src(pos), scratch, trigger=now):
        q.awaitTermination()
    jobs.start_requests(src(req), scratch, trigger=now).awaitTermination()
    jobs.start_motion(src(pos), scratch, trigger=now).awaitTermination()
    jobs.start_tracks(src(pos), scratch, trigger=now).awaitTermination()

    assert sinks.read_history(spark, f"{scratch}/archive").count() == f.count()
    rej = spark.read.parquet(f"{scratch}/rejected_requests")
    reqs = fx.requests(spark, SF_SMALL)
    assert rej.count() == reqs.where(~F.col("choice_id").isin(1, 2, 3)).count()
    assert {r.reject_reason for r in rej.select("reject_reason").distinct().collect()} == \
        {"missing_choice", "invalid_choice"}
    assert spark.read.parquet(f"{scratch}/quarantine").count() == 1
    assert snapshots.read_latest(spark, f"{scratch}/snapshot").count() == 5
    assert state.read_snapshot(spark, f"{scratch}/map_features").where("kind = 'observer'").count() == 1
    closest = codecs.decode_responses(spark.read.parquet(f"{scratch}/responses")
                                      .where(F.col("value").startswith("{")))
    assert closest.count() == E.queries()["closest_satellite"](spark, SF_SMALL).count()
    v = state.last_revision(spark.read.parquet(f"{scratch}/vectors"))
    assert v.count() == motion.motion_vectors(f).count()
    msgs = spark.read.parquet(f"{scratch}/motion_messages")
    assert msgs.count() > 0
    w = jobs.read_windows(spark, scratch)
    assert w.count() == windows.sliding_positions(f).count()
    drawn = state.read_snapshot(spark, f"{scratch}/map")
    batch_tracks = trk.tracks(windows.sliding_positions(f), windows.data_now(f))
    assert drawn.count() == batch_tracks.count()
    assert {"track", "head", "popup", "title"} <= set(drawn.columns)
    now = windows.data_now(f)
    got = sorted((r.sat_id, r.path) for r in trk.tracks(w, now).collect())
    assert got == sorted((r.sat_id, r.path) for r in trk.tracks(windows.sliding_positions(f), now).collect())



def test_requests_before_any_fix(spark, scratch):
    """No archive yet: the batch completes and nothing is answered."""
    src = streams.stage(fx.raw_requests(spark, SF_SMALL), f"{scratch}/req")
    req = ingest.parse_requests(sources.read_files(spark, src, max_files_per_trigger=1))
    sinks.start(req, f"{scratch}/ck", trigger={"availableNow": True},
                foreach_batch=lambda b, i: state.answer_requests(b, i, f"{scratch}/none", f"{scratch}/resp")
                ).awaitTermination()
    assert not os.path.exists(f"{scratch}/resp")


def test_command_line_jobs(spark, scratch):
    """``python -m groundtrack`` on file folders (same process, same session)."""
    from groundtrack.__main__ import main
    pos = streams.stage(streams.encode_raw(fx.irregular(spark, SF_SMALL)), f"{scratch}/pos")
    req = streams.stage(fx.raw_requests(spark, SF_SMALL), f"{scratch}/req")
    rc = main(["positions", "requests", "motion", "tracks", "--root", f"{scratch}/out",
               "--positions", pos, "--requests", req, "--available-now"])
    assert rc == 0
    for t in ("archive", "snapshot", "responses", "vectors", "windows"):
        assert os.path.exists(f"{scratch}/out/{t}"), t


def test_compact_history(spark, scratch):
    f = fx.irregular(spark, SF_SMALL)
    for i in range(3):
        sinks.history_append(f.where(F.col("seq") % 3 == i), i, f"{scratch}/h", sat_id=None)
    sinks.compact_history(spark, f"{scratch}/h", f"{scratch}/c")
    sinks.compact_history(spark, f"{scratch}/h", f"{scratch}/c")          # idempotent
    c = spark.read.parquet(f"{scratch}/c")
    assert c.count() == f.count()
    assert sorted(os.listdir(f"{scratch}/c/sat_id=49810"))[0].startswith("day=")
    lo, hi = 1704100000, 1704300000
    r = sinks.read_history_range(spark, f"{scratch}/c", lo, hi)
    assert r.count() == f.where(F.col("timestamp").between(lo, hi)).count()
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]


def test_console_and_memory_sinks(spark, scratch, capsys):
    """The built-in sinks work through the same starter (checkpoint set)."""
    src = streams.stage(streams.encode_raw(fx.ticks(spark, SF_SMALL)), f"{scratch}/in")
    s = _positions(spark, src).select("sat_id", "timestamp")
    q = sinks.start(s, f"{scratch}/ck1", fmt="memory", query_name="gt_mem", trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.table("gt_mem").count() == fx.ticks(spark, SF_SMALL).count()
    q = sinks.start(s.limit(0), f"{scratch}/ck2", fmt="console", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def test_crash_after_write_is_not_duplicated(spark, scratch):
    """A batch that dies after writing is re-run on restart; the archive
    still holds every fix once (the retried batch overwrites its own part)."""
    f = fx.ticks(spark, SF_SMALL)
    src = streams.stage(streams.encode_raw(f), f"{scratch}/in")
    crashed = {"done": False}

    def flaky(b, i):
        sinks.history_append(b, i, f"{scratch}/h", sat_id=None)
        if i == 1 and not crashed["done"]:
            crashed["done"] = True
            raise RuntimeError("executor lost after the write")

    q = sinks.start(_positions(spark, src), f"{scratch}/ck", foreach_batch=flaky,
                    trigger={"availableNow": True})
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the simulated failure
        pass
    assert crashed["done"]
    sinks.start(_positions(spark, src), f"{scratch}/ck", foreach_batch=flaky,
                trigger={"availableNow": True}).awaitTermination()
    h = sinks.read_history(spark, f"{scratch}/h")
    assert h.count() == f.count()
    assert h.groupBy("sat_id", "seq").count().where("count > 1").count() == 0


def test_final_windows_stream(spark, scratch):
    """Append mode through two chained aggregates: every window written is
    final and equals the batch window; all windows the watermark has passed
    are written."""
    f = fx.irregular(spark, SF_SMALL.replace("0.001", "0.01"))
    src = streams.stage(streams.encode_raw(f), f"{scratch}/in")
    s = windows.sliding_positions(_positions(spark, src), watermark="10 minutes", final_only=True)
    sinks.start(s, f"{scratch}/ck", fmt="parquet", path=f"{scratch}/out",
                trigger={"availableNow": True}).awaitTermination()
    got = spark.read.parquet(f"{scratch}/out")
    b = windows.sliding_positions(f)
    assert got.groupBy("window_start", "sat_id").count().where("count > 1").count() == 0
    assert got.join(b, ["window_start", "window_end", "sat_id", "satname", "latitude", "longitude",
                        "timestamp"], "left_anti").count() == 0
    mx = f.agg(F.max("timestamp")).first()[0]
    assert got.count() >= b.where(F.col("window_end") <= mx - 30 * 60).count() > 0


def test_command_line_final_windows(spark, scratch):
    from groundtrack.__main__ import main
    pos = streams.stage(streams.encode_raw(fx.irregular(spark, SF_SMALL)), f"{scratch}/pos")
    rc = main(["tracks", "--root", f"{scratch}/out", "--positions", pos, "--available-now",
               "--final-windows"])
    assert rc == 0
    w = jobs_read(spark, f"{scratch}/out")
    b = windows.sliding_positions(fx.irregular(spark, SF_SMALL))
    assert w.join(b, ["window_start", "sat_id", "latitude", "longitude"], "left_anti").count() == 0


def jobs_read(spark, root):
    from groundtrack.streaming import jobs
    return jobs.read_windows(spark, root)


# -- many days, many cores ---------------------------------------------------

def test_staged_batches_are_as_parallel_as_the_input(spark, scratch):
    raw = streams.encode_raw(fx.ticks(spark, SF_SMALL)).repartition(6)
    src = streams.stage(raw, f"{scratch}/in")
    files = sorted(f for f in os.listdir(src) if f.startswith("part-"))
    assert len(files) == 6 * streams.CHUNKS
    q = sinks.start(streams.staged_stream(spark, src), f"{scratch}/ck", fmt="parquet", path=f"{scratch}/out", trigger={"availableNow": True})
    q.awaitTermination()
    assert len(q.recentProgress) == streams.CHUNKS
    cols = ["offset", "topic", "value"]
    assert sorted(map(tuple, spark.read.parquet(f"{scratch}/out").select(cols).collect())) == sorted(map(tuple, raw.select(cols).collect()))
    last = [spark.read.parquet(f"{src}/{f}").agg(F.min("offset"), F.max("offset")).first() for f in files]
    assert all(a[1] < b[0] for a, b in zip(last, last[1:]))               # consecutive ranges


def test_archive_of_many_days_has_about_a_file_a_day(spark, scratch):
    days, day = 120, 86400
    rows = spark.range(days * 40).selectExpr(
        "cast(id % 5 as string) sat_id", "concat('Sat ', id % 5) satname", "cast(id % 90 as double) latitude", "0D longitude", "0D azimuth",
        "0D elevation", f"(id div 40) * {day} + (id % 40) * 2000 timestamp", "id seq")
    sinks.history_append(rows, 0, f"{scratch}/h", sat_id=None)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = lambda p: sum(f.startswith("part-") for _, _, fs in os.walk(p) for f in fs)
    assert files(f"{scratch}/h") <= days + parts                           # 20 a day before
    assert files(f"{scratch}/h{sinks.TAILS}") == days
    got = sinks.read_history(spark, f"{scratch}/h").select(rows.columns)
    assert got.count() == days * 40 and got.exceptAll(rows).isEmpty()
    tails = spark.read.schema(sinks.ARCHIVE).parquet(f"{scratch}/h{sinks.TAILS}")
    want = rows.selectExpr(f"timestamp div {day} day", "sat_id", "seq").groupBy("day", "sat_id").agg(F.max("seq").alias("seq"))
    assert tails.select("day", "sat_id", "seq").exceptAll(want).isEmpty() and tails.count() == want.count()


def test_overlap_messages_are_read_in_small_batches(spark, scratch):
    """A reader takes thousands of rows of a row group at once: of long messages a group holds few."""
    import glob

    import pyarrow.parquet as pq
    rows = spark.range(90 * 40).selectExpr("cast(id % 90 as string) sat_id", "concat('Sat ', id % 90) satname", "id % 170 / 2D latitude", "id * 7 % 360 - 180D longitude",
                                           "0D azimuth", "0D elevation", "1000000 + id div 90 timestamp", "id seq")
    sinks.history_append(rows, 0, f"{scratch}/hist", sat_id=None)
    reqs = spark.range(40).selectExpr("concat('r', id) request_id", "0D obs_latitude", "0D obs_longitude", "0D altitude", "1000000 + id timestamp", "2 choice_id").coalesce(1)
    msgs = state.answer_requests(reqs, 0, f"{scratch}/hist", f"{scratch}/resp")
    assert codecs.decode_responses(msgs, OVERLAP_ITEM).count() == 40 * 90 * 89 // 2
    for f in glob.glob(f"{scratch}/resp/*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        assert max(meta.row_group(g).total_byte_size for g in range(meta.num_row_groups)) < 6 << 20


def test_overlap_answers_take_each_request_on_its_own(spark, scratch):
    """Equal requests, one id at two times, a null id: as many pairs as requests ask for;
    the counts made from the objects hold, and no join meets the pairs again."""
    from groundtrack.operators import asof
    fixes = spark.createDataFrame([(i, f"Sat {i}", float(k), 0.0, 0.0, 0.0, t, 10 * t + k) for t, n in ((100, 3), (200, 4), (300, 1))
                                   for k, i in enumerate(["a", "b", "c", "d"][:n])], POS)
    reqs = spark.createDataFrame([("x", 0.0, 0.0, 0.0, 100, 2)] * 2 + [("y", 0.0, 0.0, 0.0, t, 2) for t in (100, 200)] + [(None, 0.0, 0.0, 0.0, 200, 2), ("z", 0.0, 0.0, 0.0, 50, 2)], REQS)
    pairs = asof.overlap_answers(reqs, fixes, total="n")
    assert "n" not in asof.overlap_answers(reqs, fixes).columns
    assert {(r.request_id, r["count"]) for r in pairs.groupBy("request_id").count().collect()} == {("x", 6), ("y", 9), (None, 6)}
    assert {(r.request_id, r.n) for r in pairs.where("request_id is not null").select("request_id", "n").distinct().collect()} == {("x", 6), ("y", 9)}
    pairs.write.parquet(f"{scratch}/pairs")
    made = spark.read.parquet(f"{scratch}/pairs")
    msgs = codecs.overlap_response(made, 4, "request_id", total="n")
    assert "Join" not in msgs._jdf.queryExecution().executedPlan().toString()
    want = codecs.overlap_response(made, 4, "request_id")
    assert msgs.exceptAll(want).isEmpty() and want.exceptAll(msgs).isEmpty() and want.count() > 3


def test_overlap_messages_shuffle_no_pairs(spark, scratch, monkeypatch):
    """Objects are dealt by request before they pair up; the pairs stay where
    they are built until they are messages."""
    import re

    from groundtrack.operators import asof
    fixes = spark.createDataFrame([(f"{k}" if k else None, f"Sat {k}", float(k % 80), float(7 * k % 360 - 180), 0.0, 0.0, 100 + t, 100 * t + k)
                                   for t in range(6) for k in range(20)] + [("3", "Twin", 1.0, 2.0, 0.0, 0.0, 102, 999)], POS)
    reqs = spark.createDataFrame([(f"r{t % 4}", 0.0, 0.0, 0.0, 100 + t, 2) for t in range(6)] + [(None, 0.0, 0.0, 0.0, 103, 2)] * 2, REQS)
    seen = asof.asof_by_time(reqs, fixes, asof.POSITION_COLS)
    monkeypatch.setattr(asof, "PAIRS_A_TASK", 100)
    pairs = asof.overlap_answers(reqs, fixes, seen=seen, total="n")
    plain = asof.overlap_answers(reqs, fixes, seen=seen)
    assert pairs.select(plain.columns).exceptAll(plain).isEmpty() and plain.exceptAll(pairs.select(plain.columns)).isEmpty() and plain.count() > 1000
    msgs = codecs.overlap_response(pairs, 10, "request_id", total="n")
    top = msgs._jdf.queryExecution().executedPlan().toString().split("Generate ")[0]
    assert "Window" in top and "ObjectHashAggregate" in top and not re.search(r"Exchange|Join", top)
    want = codecs.overlap_response(plain, 10, "request_id")
    assert msgs.select(want.columns).exceptAll(want).isEmpty() and want.exceptAll(msgs.select(want.columns)).isEmpty()


def test_messages_are_stored_small(spark, scratch):
    import glob
    rows = spark.range(60 * 20).selectExpr("cast(id % 60 as string) sat_id", "concat('Sat ', id % 60) satname", "id % 170 / 2D latitude", "id * 7 % 360 - 180D longitude",
                                           "0D azimuth", "0D elevation", "1000000 + id div 60 timestamp", "id seq")
    sinks.history_append(rows, 0, f"{scratch}/hist", sat_id=None)
    reqs = spark.range(20).selectExpr("concat('r', id) request_id", "0D obs_latitude", "0D obs_longitude", "0D altitude", "1000000 + id timestamp", "2 choice_id")
    msgs = state.answer_requests(reqs, 0, f"{scratch}/hist", f"{scratch}/resp")
    assert codecs.decode_responses(msgs, OVERLAP_ITEM).count() == 20 * 60 * 59 // 2
    stored = sum(os.path.getsize(f) for f in glob.glob(f"{scratch}/resp/*/*.parquet"))
    assert 7 * stored < msgs.selectExpr("sum(length(value))").first()[0]
