"""Streams joined in state, keyed state that only grows by what arrives, deltas,
roll-ups, the record log, supervision: restarts, late rows, failures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from groundtrack.operators import asof, codecs, ingest, latest, motion, windows
from groundtrack.plans import streams
from groundtrack.schemas import MOTION_ITEM
from groundtrack.sources import fixtures as fx
from groundtrack.streaming import jobs, keyed, live, records, rollup, sinks, snapshots, sources, state, supervise

from conftest import SF_SMALL

POS = ("sat_id string, satname string, latitude double, longitude double, azimuth double, "
       "elevation double, timestamp bigint, seq bigint")
REQS = "request_id long, obs_latitude double, obs_longitude double, altitude double, timestamp long, choice_id int"
NOW = {"availableNow": True}


def positions(spark, rows, folder=None):
    df = spark.createDataFrame([(s, f"Sat {s}", la, lo, 0.0, 0.0, t, q) for s, la, lo, t, q in rows], POS)
    if folder:
        streams.encode_raw(df).coalesce(1).write.mode("append").parquet(folder)
    return df


def asks(spark, rows, folder):
    codecs.encode_requests(spark.createDataFrame([(i, 0.0, 0.0, 0.0, t, 3) for i, t in rows], REQS)).select(
        "value", "topic", F.col("key").cast("bigint").alias("offset")).coalesce(1).write.mode("append").parquet(folder)


def fixes_of(spark, folder, n=1):
    ok, _ = ingest.split(ingest.parse_positions(sources.read_files(spark, folder, max_files_per_trigger=n)))
    return ok


def requests_of(spark, folder):
    return ingest.parse_requests(sources.read_files(spark, folder, max_files_per_trigger=1))


def run(df, d, **kw):
    q = sinks.start(df, f"{d}/ck", fmt="parquet", path=f"{d}/out", trigger=NOW, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return df.sparkSession.read.parquet(f"{d}/out") if os.path.exists(f"{d}/out") else None


# -- requests joined to fixes ------------------------------------------------

def test_live_asof_restarts_and_drops_late_rows(spark, scratch):
    T = 1_800_000_000
    positions(spark, [("1", 0.0, 0.0, T, 1), ("2", 5.0, 0.0, T + 10, 2), ("1", 1.0, 0.0, T + 60, 3)], f"{scratch}/p")
    asks(spark, [(1, T + 30), (2, T + 60), (3, T - 5)], f"{scratch}/r")
    q = lambda: live.asof_live(requests_of(spark, f"{scratch}/r"), fixes_of(spark, f"{scratch}/p"), 600, "1 minute", spread=3)
    first = run(q(), scratch)
    assert first is None or first.count() == 0                       # the watermark has passed no request yet
    # restart: state holds what came before; a fix that is late for request 2 is dropped, one out of order but in time is seen
    positions(spark, [("2", 6.0, 0.0, T + 59, 4)], f"{scratch}/p")
    asks(spark, [(4, T + 600)], f"{scratch}/r")
    run(q(), scratch)
    positions(spark, [("1", 2.0, 0.0, T + 3000, 5)], f"{scratch}/p")
    asks(spark, [(5, T + 3000)], f"{scratch}/r")
    run(q(), scratch)
    positions(spark, [("1", 9.0, 0.0, T + 59, 6), ("1", 3.0, 0.0, T + 9000, 7)], f"{scratch}/p")
    asks(spark, [(6, T + 20), (7, T + 9000)], f"{scratch}/r")
    got = {(r.request_id, r.sat_id): r.fix_seq for r in run(q(), scratch).collect()}
    assert got == {("1", "1"): 1, ("1", "2"): 2, ("2", "1"): 3, ("2", "2"): 4, ("4", "1"): 3, ("4", "2"): 4, ("5", "1"): 5}


def test_live_equals_batch_asof(spark, scratch):
    f, r = fx.irregular(spark, SF_SMALL), fx.requests(spark, SF_SMALL).where("choice_id = 3")
    want = sorted(map(tuple, asof.asof_positions(r, f, 3600).collect()))
    got = sorted(map(tuple, live.asof_live(r, f, 3600).drop("request_time").collect()))        # the same plan on tables
    assert got == want
    s = streams.asof_live(spark, SF_SMALL)
    assert sorted((int(x[0]), *x[1:]) for x in s.collect()) == want


def test_live_asof_pairs_no_request_with_all_its_fixes(spark, scratch):
    """No join of requests and fixes; of many fixes of a second and object the
    greatest seq is seen, of a request sent twice there is one answer."""
    T = 1_800_000_000
    positions(spark, [("1", i / 10, 0.0, T, i) for i in range(50)] + [("2", 1.0, 0.0, T + 1, 50)], f"{scratch}/p")
    positions(spark, [("2", 2.0, 0.0, T + 9000, 51)], f"{scratch}/p")
    asks(spark, [(7, T), (7, T), (8, T + 1)], f"{scratch}/r")
    asks(spark, [(9, T + 9000)], f"{scratch}/r")
    rows = live.asof_live(requests_of(spark, f"{scratch}/r"), fixes_of(spark, f"{scratch}/p"), 600, "1 minute", spread=2)
    assert "Join" not in rows._jdf.queryExecution().logical().toString()
    assert sorted((r.request_id, r.sat_id, r.fix_seq) for r in run(rows, scratch).collect()) == [("7", "1", 49), ("8", "1", 49), ("8", "2", 50)]


def test_live_job_answers_closest(spark, scratch):
    T = 1_800_000_000
    positions(spark, [("1", 0.0, 10.0, T, 1), ("2", 0.0, 5.0, T, 2), ("3", 0.0, -5.0, T + 1, 3), ("4", 0.0, 0.0, T + 9000, 4)], f"{scratch}/p")
    asks(spark, [(1, T), (2, T + 1), (3, T + 9000)], f"{scratch}/r")
    q = jobs.start_live(sources.read_files(spark, f"{scratch}/p"), sources.read_files(spark, f"{scratch}/r"), scratch, 300, trigger=NOW)
    q.awaitTermination()
    out = codecs.decode_responses(spark.read.schema("topic string, key string, value string, batch_id bigint").parquet(f"{scratch}/live_responses"))
    assert {r.key: r.sat_id for r in out.collect()} == {"1": "2", "2": "2"}          # ties: the lower id


# -- keyed state ------------------------------------------------------------

def test_motion_state_has_few_keys_and_packed_entries(spark, scratch, monkeypatch):
    """An hour of an object is one key; entries made one keep names, null offsets
    and coordinates."""
    T = 1_800_000_000 // 3600 * 3600
    monkeypatch.setattr(keyed, "ENTRIES", 2)
    rows = [("1", float(i), 0.0, T + 60 * i, i) for i in range(8)]
    for r in rows:
        positions(spark, [r], f"{scratch}/in")
    s = keyed.motion_stream(fixes_of(spark, f"{scratch}/in").withColumn("seq", F.when(F.col("seq") != 3, F.col("seq"))), 300, "5 minutes")
    q = sinks.start(s, f"{scratch}/ck", fmt="parquet", path=f"{scratch}/out", trigger=NOW)
    q.awaitTermination()
    assert max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators) <= 8
    got = state.last_revision(spark.read.parquet(f"{scratch}/out")).orderBy("timestamp").collect()
    assert [(r.timestamp - T, r.prev_timestamp - T, r.seq, r.satname) for r in got] == [
        (60 * i, 60 * max(0, i - 5), None if i == 3 else i, got[0].satname) for i in range(1, 8)]


def test_motion_state_is_appended_and_cleared(spark, scratch):
    """Chunks of 600 s: vectors reach over their border, revisions come in order,
    the state of chunks behind the watermark goes."""
    T = 1_800_000_000 // 600 * 600
    rows = [("1", i / 10, 0.0, T + 90 * i, i) for i in range(14)]
    positions(spark, rows[:7] + rows[8:10], f"{scratch}/in")
    positions(spark, [rows[7]] + rows[10:], f"{scratch}/in")
    positions(spark, [("1", 5.0, 0.0, T + 9000, 90)], f"{scratch}/in")
    positions(spark, [("1", 5.1, 0.0, T + 9060, 91), ("1", 7.0, 0.0, T + 100, 92)], f"{scratch}/in")        # the second is late
    s = keyed.motion_stream(fixes_of(spark, f"{scratch}/in"), 300, "5 minutes", chunk_s=600)
    q = sinks.start(s, f"{scratch}/ck", fmt="parquet", path=f"{scratch}/out", trigger=NOW)
    q.awaitTermination()
    got = state.last_revision(spark.read.parquet(f"{scratch}/out"))
    want = motion.motion_vectors(positions(spark, [*rows, ("1", 5.0, 0.0, T + 9000, 90), ("1", 5.1, 0.0, T + 9060, 91)]), 300)
    cols = ["sat_id", "timestamp", "seq", "prev_timestamp", "velocity_kmph"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4         # only the last chunk is left


def test_equal_seconds_with_far_offsets_are_told_apart(spark, scratch):
    """Predecessors are known by time and offset: a fix of the same second whose
    offset differs by any number is another one."""
    rows = [("1", 0.0, 0.0, 1000, 1_000_004), ("1", 1.0, 0.0, 1030, 1_000_005), ("1", 2.0, 0.0, 1000, 1)]
    positions(spark, rows[:2], f"{scratch}/in")
    positions(spark, rows[2:], f"{scratch}/in")
    out = run(keyed.motion_stream(fixes_of(spark, f"{scratch}/in"), watermark="1 hour"), scratch)
    last = {r.seq: (r.prev_timestamp, r.delta_latitude) for r in state.last_revision(out).collect()}
    assert last == {1_000_004: (1000, 0.0), 1_000_005: (1000, -1.0)}


def final(df):
    v = df.groupBy("window_start", "window_end", "sat_id", "satname").agg(F.max_by(F.struct("latitude", "longitude", "timestamp"), "batch_id").alias("v"))
    return v.select("window_start", "window_end", "sat_id", "satname", "v.*")


def panes(spark, scratch, src, **kw):
    out = f"{scratch}/out"
    q = sinks.start(keyed.sliding_panes(src, **kw), f"{scratch}/ck", mode="update", trigger=NOW,
                    foreach_batch=lambda b, i: b.withColumn("batch_id", F.lit(int(i))).write.mode("append").parquet(out))
    q.awaitTermination()
    return spark.read.parquet(out), q


def test_panes_equal_batch_windows(spark, scratch):
    f = fx.irregular(spark, SF_SMALL)
    src = streams.stage(streams.encode_raw(f), f"{scratch}/in")
    got, q = panes(spark, scratch, fixes_of(spark, src))
    cols = ["window_start", "window_end", "sat_id", "satname", "latitude", "longitude", "timestamp"]
    want = sorted(map(tuple, windows.sliding_positions(f).select(cols).collect()))
    assert sorted(map(tuple, final(got).select(cols).collect())) == want


def test_panes_hold_a_row_a_slot_and_drop_late_rows(spark, scratch):
    T = 1_800_000_000 // 7200 * 7200
    dense = [("1", float(i % 90), 0.0, T + i, i) for i in range(0, 600, 5)]
    positions(spark, dense, f"{scratch}/in")
    positions(spark, [("1", 50.0, 0.0, T + 300, 1000)], f"{scratch}/in")                 # out of order: a slot's later offset
    positions(spark, [("1", 60.0, 0.0, T + 5400, 1001)], f"{scratch}/in")                # the watermark moves
    positions(spark, [("1", 61.0, 0.0, T + 5500, 1002), ("1", 99.0, 0.0, T + 30, 1003)], f"{scratch}/in")
    out = f"{scratch}/out"
    rows = []

    def keep(b, i):
        b.withColumn("batch_id", F.lit(int(i))).write.mode("append").parquet(out)

    q = sinks.start(keyed.sliding_panes(fixes_of(spark, f"{scratch}/in"), watermark="10 minutes"), f"{scratch}/ck", mode="update",
                    foreach_batch=keep, trigger=NOW)
    q.awaitTermination()
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"]]
    assert rows[0] <= 2 * 5 + 4                                      # 120 fixes, 5 slots, each in at most two chunks
    got = final(spark.read.parquet(out))
    assert got.where("latitude = 99.0").count() == 0
    w = {r.window_start: r.latitude for r in got.where(F.col("window_end") == T + 360).collect()}
    assert w == {T + 360 - 1800: 355 % 90}
    with pytest.raises(ValueError):
        keyed.sliding_panes(fx.ticks(spark, SF_SMALL), "5 minutes", "2 minutes")


# -- deltas and roll-ups -----------------------------------------------------

def test_snapshot_deltas_write_what_changed(spark, scratch):
    f, path = fx.irregular(spark, SF_SMALL), f"{scratch}/s"
    assert snapshots.read_latest(spark, path) is None
    for i in range(7):
        b = f.where(F.expr(f"seq div 150 = {i}") & (F.col("sat_id") != "49810") if i % 2 else F.expr(f"seq div 150 = {i}"))
        snapshots.write_delta(b, i, path, max_deltas=3)
        assert spark.read.parquet(f"{path}/delta/v={i:020d}").count() == b.select("sat_id").distinct().count()
        assert len(os.listdir(f"{path}/delta")) <= 2 * (3 + 1) and len(os.listdir(f"{path}/base")) <= 2 if os.path.exists(f"{path}/base") else True
    seen = f.where("seq < 1050 and (sat_id != '49810' or (seq div 150) % 2 = 0)")
    cols = list(snapshots.COLUMNS)
    want = sorted(map(tuple, latest.latest_positions(seen).select(cols).collect()))
    assert sorted(map(tuple, snapshots.read_latest(spark, path).select(cols).collect())) == want
    snapshots.write_delta(f.where("seq < 150"), 0, path, max_deltas=3)                   # an old batch again
    assert sorted(map(tuple, snapshots.read_latest(spark, path).select(cols).collect())) == want


DAY = 86400


def archive(spark, scratch, batches, roll=True):
    for i, rows in enumerate(batches):
        b = positions(spark, rows)
        sinks.history_append(b, i, f"{scratch}/h", sat_id=None)
        if roll:
            rollup.advance(b, i, f"{scratch}/h")


def motion_answers(spark, scratch, asked):
    r = spark.createDataFrame([(i, 0.0, 0.0, 0.0, t, 1) for i, t in asked], REQS)
    msgs = state.answer_requests(r.withColumn("request_id", F.col("request_id").cast("string")), 0, f"{scratch}/h", f"{scratch}/resp")
    rows = codecs.decode_responses(msgs.select("key", "value"), MOTION_ITEM).collect()
    return sorted((int(x.key), x.sat_id, x.timestamp, x.velocity_kmph) for x in rows)


def test_rolled_up_answers_equal_batch(spark, scratch):
    """Days of fixes, late ones included: answers through the roll-ups are those
    over the whole history."""
    T = 20_000 * DAY
    day = lambda d, s, t, q: (s, q / 10, 0.0, T + d * DAY + t, q)
    batches = [[day(0, "1", 100, 1), day(0, "1", 200, 2), day(0, "2", 50, 3), day(0, "2", 86390, 4)],
               [day(1, "2", 5, 5), day(1, "3", 10, 6)],
               [day(1, "3", 86300, 7), day(2, "1", 10, 8)],
               [day(0, "2", 86395, 9), day(1, "3", 86350, 10)],                          # late: changes vectors of both days
               [day(3, "1", 20, 11), day(4, "1", 30, 12)]]
    archive(spark, scratch, batches)
    assert [d for d, _ in rollup.rollups(spark, f"{scratch}/h")] == [20_000, 20_001, 20_002, 20_004]
    asked = [(1, T + DAY - 1), (2, T + DAY + 7), (3, T + 2 * DAY + 5), (4, T + 5 * DAY), (5, T + 4 * DAY + 31)]
    got = []
    for a in asked:                                                  # one at a time: each reads another roll-up
        got += motion_answers(spark, scratch, [a])
    f = positions(spark, sum(batches, []))
    r = spark.createDataFrame([(i, 0.0, 0.0, 0.0, t, 1) for i, t in asked], REQS)
    want = asof.motion_answers(r, motion.motion_vectors(f)).collect()
    assert sorted(got) == sorted((x.request_id, x.sat_id, x.vector_ts, x.velocity_kmph) for x in want)
    cached = rollup.cache(spark, f"{scratch}/h", T + 4 * DAY, T + 5 * DAY)
    a = asof.asof_positions(r.where("request_id >= 4"), cached).collect()
    b = asof.asof_positions(r.where("request_id >= 4"), f).collect()
    assert sorted((x.request_id, x.sat_id, x.fix_ts, x.fix_seq) for x in a) == sorted((x.request_id, x.sat_id, x.fix_ts, x.fix_seq) for x in b)


def test_answers_read_the_days_they_reach(spark, scratch):
    T = 20_000 * DAY
    archive(spark, scratch, [[("1", i / 10, 0.0, T + d * DAY + 60 * i, 10 * d + i) for i in range(3)] for d in range(10)])
    last = T + 9 * DAY
    for df in (rollup.vectors(spark, f"{scratch}/h", last + 50, last + 70), rollup.cache(spark, f"{scratch}/h", last + 50, last + 70)):
        assert {p.split("_rollup/v=")[1].split("-")[0] for p in df.inputFiles() if "_rollup/v=" in p} == {"20009"}        # one roll-up
        assert df.count() >= 2
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(day" in plan
    n = spark.read.parquet(f"{scratch}/h").count()
    opened = rollup.vectors(spark, f"{scratch}/h", last + 50, last + 70)
    assert opened.count() == 1 + 1 and n == 30                       # a vector of the day, and the object's last before
    assert len(rollup.rollups(spark, f"{scratch}/h")) == rollup.KEPT


def test_without_rollups_answers_are_the_same(spark, scratch):
    T = 20_000 * DAY
    batches = [[("1", 0.0, 0.0, T, 1), ("1", 1.0, 0.0, T + 60, 2)], [("2", 0.0, 0.0, T + DAY, 3), ("2", 1.0, 0.0, T + DAY + 9, 4)]]
    archive(spark, scratch, batches, roll=False)
    assert [x[:3] for x in motion_answers(spark, scratch, [(1, T + 2 * DAY)])] == [(1, "1", T + 60), (1, "2", T + DAY + 9)]


# -- record log --------------------------------------------------------------

def written(spark, scratch, rows, **options):
    records.register(spark)
    folder = f"{scratch}/in"
    spark.createDataFrame(rows, "topic string, value string").coalesce(1).write.mode("append").parquet(folder)
    src = spark.readStream.schema("topic string, value string").option("maxFilesPerTrigger", 1).parquet(folder)
    w = src.writeStream.format(records.NAME).option("checkpointLocation", f"{scratch}/ck_log")
    for k, v in options.items():
        w = w.option(k, v)
    q = w.trigger(availableNow=True).start(f"{scratch}/log")
    q.awaitTermination()
    assert q.exception() is None


def test_log_keeps_offsets_and_restarts_inside_a_file(spark, scratch):
    rows = [("satellite-1" if i % 3 else "other", f"line\n{i} é") for i in range(100)]
    written(spark, scratch, rows)
    seen = []

    def start(most):
        log = records.read_log(spark, f"{scratch}/log", subscribePattern=r"satellite-\d+", maxRecordsPerBatch=most, progress=f"{scratch}/p")
        return sinks.start(log, f"{scratch}/ck", foreach_batch=lambda b, i: seen.append([tuple(r) for r in b.collect()]))

    q = start(30)
    while len(seen) < 2:                                             # stop in the middle of the only file
        q.processAllAvailable() if len(seen) >= 4 else None
        assert q.isActive
    q.stop()
    before = sum(map(len, seen))
    written(spark, scratch, [("satellite-2", None), (None, "no topic")])
    q = start(7)
    q.processAllAvailable()
    q.stop()
    got = {r for b in seen for r in b}
    want = {(v, t, 0, i) for i, (t, v) in enumerate(rows) if t != "other"} | {(None, "satellite-2", 0, 100)}
    assert got == want and before < len(want)
    assert all(len(b) <= 30 for b in seen)
    assert spark.read.format(records.NAME).load(f"{scratch}/log").count() == 102


def test_log_counts_only_what_was_committed(spark, scratch):
    written(spark, scratch, [("t", str(i)) for i in range(5)])
    log = records.Log(f"{scratch}/log")
    name, out = log.new_segment()                                    # a task that died
    out.write(b'["t", "lost"]\n')
    out.close()
    assert spark.read.format(records.NAME).load(f"{scratch}/log").count() == 5
    w = records.RecordStreamWriter({"path": f"{scratch}/log"})
    w.commit([records.Written(name, 0, 1)], 0)                       # batch 0 again, after a restart
    assert spark.read.format(records.NAME).load(f"{scratch}/log").count() == 5 and not log.exists("segments", name)
    assert json.loads(log.text("commits", log.names("commits")[0]))[0]["base"] == 0
    empty = records.read_log(spark, f"{scratch}/nothing", startingOffsets="latest")
    assert empty.isStreaming and spark.read.format(records.NAME).load(f"{scratch}/nothing").count() == 0


# -- supervision -------------------------------------------------------------

def test_supervisor_counts_late_rejected_and_failed(spark, scratch):
    T = 1_800_000_000
    positions(spark, [("1", 0.0, 0.0, T, 1)], f"{scratch}/in")
    positions(spark, [("1", 1.0, 0.0, T + 7200, 2)], f"{scratch}/in")
    positions(spark, [("1", 2.0, 0.0, T + 7300, 3)], f"{scratch}/in")
    positions(spark, [("1", 9.0, 0.0, T + 60, 4)], f"{scratch}/in")
    spark.createDataFrame([("junk", "satellite-1", 9)], "value string, topic string, offset long").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    with supervise.supervised(spark, kept=3) as seen:
        rows = supervise.observed(ingest.parse_positions(sources.read_files(spark, f"{scratch}/in", max_files_per_trigger=1)), "rows", n_north=F.col("latitude") > 0)
        ok, _ = ingest.split(rows)
        q = sinks.start(windows.sliding_positions(ok, watermark="10 minutes"), f"{scratch}/ck", mode="update", fmt="memory", query_name="gt_sup", trigger=NOW)
        q.awaitTermination()
        bad = sinks.start(sources.read_files(spark, f"{scratch}/in"), f"{scratch}/ck2", foreach_batch=lambda b, i: 1 / 0, query_name="gt_bad", trigger=NOW)
        with pytest.raises(Exception):
            bad.awaitTermination()
    t = seen.totals()
    assert t["gt_sup"]["n_rows"] == 5 and t["gt_sup"]["n_rejected"] == 1 and t["gt_sup"]["n_north"] == 3 and t["gt_sup"]["late_rows"] >= 1
    assert t["gt_bad"]["failures"] == 1 and t["gt_sup"]["failures"] == 0 and len(seen.batches("gt_sup")) == 3


def test_keep_running_restarts_from_the_checkpoint(spark, scratch):
    f = fx.ticks(spark, SF_SMALL)
    src = streams.stage(streams.encode_raw(f), f"{scratch}/in")
    tries = []

    def start():
        def body(b, i):
            if i == 1 and len(tries) < 3:
                raise RuntimeError("lost")
            sinks.history_append(b, i, f"{scratch}/h", sat_id=None)
        return sinks.start(fixes_of(spark, src), f"{scratch}/ck", foreach_batch=body, trigger=NOW)

    supervise.keep_running(start, restarts=3, pause_s=0.01, told=tries.append)
    assert len(tries) == 3 and sinks.read_history(spark, f"{scratch}/h").count() == f.count()
    with pytest.raises(Exception):
        supervise.keep_running(lambda: sinks.start(fixes_of(spark, src), f"{scratch}/ck3", foreach_batch=lambda b, i: 1 / 0, trigger=NOW), restarts=1, pause_s=0.01)
