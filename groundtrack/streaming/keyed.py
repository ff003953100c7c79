"""Keyed state that only grows by what arrives: motion vectors, live sliding
windows and the as-of lookup of requests on the arbitrary-state API
(``transformWithState``).

The first two cut an object's time into chunks and key the state by (object,
chunk), so a busy object is spread over tasks and a chunk's whole state goes
with one event-time timer. Rows that a chunk needs of its neighbour are sent to
both. State lives in the RocksDB store (``use_rocksdb``), off the heap.

* ``motion_stream``: the chunk's fixes, one packed entry for what a micro-batch
  brought; many small entries are made one.
* ``sliding_panes``: a map from slot (one slide) to the latest fix of the slot.
  A fix changes at most its own slot; the windows that contain a changed slot
  are put together from their slots and sent again (update mode). The state has
  one row a slot whatever the number of windows that a fix lies in, and input
  rows are not copied into windows.
* ``AsofRequests`` (for ``live``): what a micro-batch brought of a time bucket
  and group of objects, packed, of several fixes of an object in one second
  only the last; and the requests that the watermark has not passed.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from groundtrack.functions.timefn import to_event_time
from groundtrack.operators import motion, windows
from groundtrack.params import LOOKBACK_S, SLIDE, WATERMARK, WINDOW

# Workers need numpy and pandas only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NO_SEQ = motion.NO_SEQ
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that ``transformWithState`` needs, unless the session
    names another one. A query that restarts keeps the store it began with."""
    if "RocksDB" not in (spark.conf.get(_PROVIDER, "") or ""):
        spark.conf.set(_PROVIDER, ROCKSDB)


# -- motion vectors ----------------------------------------------------------

VECTOR = ("sat_id string, satname string, timestamp bigint, seq bigint, latitude double, longitude double, "
          "prev_timestamp bigint, prev_latitude double, prev_longitude double, revision bigint")
#: Look-backs in a chunk: each key costs a task more than its fixes do.
CHUNK = 12
#: Packed entries of a key from which on they are made one.
ENTRIES = 32
_FIX = ("timestamp", "seq", "latitude", "longitude", "satname", "own")
_VECTOR = [c.split()[0] for c in VECTOR.split(", ")]


def _predecessors(ts: np.ndarray, seq: np.ndarray, lookback_s: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fix the row of its predecessor (the oldest within the look-back),
    and whether there is one."""
    order = np.lexsort((seq, ts))
    t, s = ts[order], seq[order]
    j = np.searchsorted(t, t - lookback_s, side="left")
    before = (t[j] < t) | (s[j] < s)
    row, there = np.empty(len(t), np.int64), np.empty(len(t), bool)
    row[order], there[order] = order[j], before
    return row, there


def _columns(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """The columns ``_FIX``: plain arrays, a chunk has too few rows for frames."""
    seq, name = pdf["seq"], pdf["satname"].to_numpy(object)
    if seq.dtype != np.int64:
        seq = seq.astype("Int64").fillna(NO_SEQ).astype("int64")
    return (pdf["timestamp"].to_numpy(np.int64), seq.to_numpy(np.int64), pdf["latitude"].to_numpy(float), pdf["longitude"].to_numpy(float),
            np.where(pd.isna(name), None, name), pdf["own"].to_numpy(bool))


def _pickled(columns: tuple[np.ndarray, ...]) -> tuple[bytes]:
    return (pickle.dumps(columns, pickle.HIGHEST_PROTOCOL),)


class MotionVectors(StatefulProcessor):
    """State of (object, chunk): its fixes, and those of the look-back before it
    (``own`` false). A fix that comes out of order, but within the watermark, is
    treated like any other; fixes whose predecessor it changes are sent again
    with a higher ``revision`` (the number of fixes held)."""

    def __init__(self, lookback_s: int, chunk_s: int):
        self._lookback_s, self._chunk_s = lookback_s, chunk_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._fixes = handle.getListState("fixes", "packed binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [pickle.loads(bytes(r[0])) for r in self._fixes.get()]
        if not parts:
            self._handle.registerTimer((int(key[1]) + 1) * self._chunk_s * 1000)
        held = tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else None
        if len(parts) >= ENTRIES:
            self._fixes.put([_pickled(held)])
        for pdf in rows:
            if not len(pdf):
                continue
            new = _columns(pdf)
            self._fixes.appendValue(_pickled(new))
            both = tuple(np.concatenate(c) for c in zip(held, new, strict=True)) if held else new
            ts, seq, lat, lon, name, own = both
            row, there = _predecessors(ts, seq, self._lookback_s)
            send = there & own
            if held:                                         # what was sent already, and has not changed
                n = len(held[0])
                old_row, old_there = _predecessors(*held[:2], self._lookback_s)
                send[:n] &= ~old_there | (old_row != row[:n])
            at = np.flatnonzero(send)
            if len(at):
                p = row[at]
                yield pd.DataFrame({
                    "sat_id": key[0], "satname": name[at], "timestamp": ts[at], "seq": pd.arrays.IntegerArray(seq[at], seq[at] == NO_SEQ),
                    "latitude": lat[at], "longitude": lon[at], "prev_timestamp": ts[p], "prev_latitude": lat[p], "prev_longitude": lon[p],
                    "revision": len(ts)}, columns=_VECTOR)
            held = both

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._fixes.clear()                                  # the watermark has passed the chunk: no fix of it can come
        yield from ()

    def close(self) -> None:
        pass


def motion_stream(fixes: DataFrame, lookback_s: int = LOOKBACK_S, watermark: str = "10 minutes", digits: bool = True,
                  chunk_s: int | None = None) -> DataFrame:
    """Motion vectors of a stream of accepted fixes: the columns of
    ``motion_vectors`` plus ``revision``. Of several rows of one fix the one with
    the greatest revision holds (``state.last_revision``)."""
    L = int(lookback_s)
    C = int(chunk_s or CHUNK * L)
    if C < L:
        raise ValueError("chunk_s must not be below lookback_s")
    use_rocksdb(fixes.sparkSession)
    chunk = F.floor(F.col("timestamp") / F.lit(C)).cast("bigint")
    src = (fixes.where(F.col("timestamp").isNotNull())
           .select("sat_id", "satname", "latitude", "longitude", "timestamp", "seq", to_event_time("timestamp").alias("event_time"))
           .withWatermark("event_time", watermark).withColumn("_c", chunk))
    # a fix of the last look-back of its chunk is also read by the next one
    near_end = F.col("timestamp") >= (F.col("_c") + 1) * F.lit(C) - F.lit(L)
    to = F.when(near_end, F.array(F.struct(F.col("_c").alias("chunk"), F.lit(True).alias("own")),
                                  F.struct((F.col("_c") + 1).alias("chunk"), F.lit(False).alias("own")))
                ).otherwise(F.array(F.struct(F.col("_c").alias("chunk"), F.lit(True).alias("own"))))
    rows = src.select("*", F.explode(to).alias("_to")).select(
        "sat_id", F.col("_to.chunk").alias("chunk"), "timestamp", "seq", "latitude", "longitude", "satname", F.col("_to.own").alias("own"), "event_time")
    pairs = rows.groupBy("sat_id", "chunk").transformWithStateInPandas(
        MotionVectors(L, C), outputStructType=VECTOR, outputMode="Append", timeMode="EventTime")
    return pairs.select("sat_id", "satname", "timestamp", "seq",
                        *motion.vector_columns("prev_timestamp", "prev_latitude", "prev_longitude", digits), "revision")


# -- sliding windows ---------------------------------------------------------

WINDOW_ROW = ("window_start bigint, window_end bigint, sat_id string, satname string, latitude double, longitude double, timestamp bigint")
PANE = "timestamp bigint, seq bigint, latitude double, longitude double"


class Panes(StatefulProcessor):
    """State of (object, name, chunk of window starts): the latest fix of each slot."""

    def __init__(self, window_s: int, slide_s: int, chunk_slots: int):
        self._window_s, self._slide_s, self._chunk = window_s, slide_s, chunk_slots

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._panes = handle.getMapState("panes", "slot bigint", PANE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, first = self._window_s // self._slide_s, int(key[2]) * self._chunk
        panes = {int(k[0]): tuple(v) for k, v in self._panes.iterator()}
        if not panes:
            self._handle.registerTimer(((first + self._chunk - 1) * self._slide_s + self._window_s) * 1000)
        changed = set()
        for pdf in rows:
            f = pdf.assign(seq=pdf["seq"].astype("Int64").fillna(NO_SEQ).astype("int64")).sort_values(["timestamp", "seq"])
            for r in f.groupby(f["timestamp"] // self._slide_s).tail(1).itertuples(index=False):     # the latest of each slot
                slot, pane = int(r.timestamp) // self._slide_s, (int(r.timestamp), int(r.seq), _float(r.latitude), _float(r.longitude))
                if slot not in panes or pane[:2] > panes[slot][:2]:
                    panes[slot] = pane
                    changed.add(slot)
        for slot in changed:
            self._panes.updateValue((slot,), panes[slot])
        closed = timerValues.getCurrentWatermarkInMs() // 1000
        out = []
        for start in sorted({s for slot in changed for s in range(max(first, slot - n + 1), min(first + self._chunk - 1, slot) + 1)}):
            last = max((s for s in range(start, start + n) if s in panes))       # a later slot's fix is the later one
            begin = start * self._slide_s
            if last in changed and begin + self._window_s > closed:
                ts, _, lat, lon = panes[last]
                out.append((begin, begin + self._window_s, key[0], key[1], lat, lon, ts))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in WINDOW_ROW.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._panes.clear()
        yield from ()

    def close(self) -> None:
        pass


def _float(x) -> float | None:
    return None if x is None or x != x else float(x)


def sliding_panes(fixes: DataFrame, window: str = WINDOW, slide: str = SLIDE, watermark: str = WATERMARK) -> DataFrame:
    """Live sliding windows of a stream (update mode): whenever the latest fix of
    a window changes, its row is sent again. The rows of ``sliding_positions``;
    a fix counts as late when all of its windows are closed. The window must be
    a whole number of slides."""
    w, s = windows._seconds(window), windows._seconds(slide)
    delay = windows._seconds(watermark)
    if not w or not s or w % s or delay is None:
        raise ValueError("window must be a whole number of slides, all in seconds, minutes, hours or days")
    use_rocksdb(fixes.sparkSession)
    n, chunk = w // s, 4 * (w // s)
    slot = F.floor(F.col("timestamp") / F.lit(s)).cast("bigint")
    # the event time of a fix is the end of the last window it lies in: it is
    # late when that one is closed, as with Spark's own windows
    src = (fixes.where(F.col("timestamp").isNotNull())
           .select("sat_id", "satname", "latitude", "longitude", "timestamp", "seq", slot.alias("_slot"),
                   to_event_time(slot * F.lit(s) + F.lit(w)).alias("event_time"))
           .withWatermark("event_time", f"{delay + w} seconds"))
    of = lambda start: F.floor(start / F.lit(chunk)).cast("bigint")
    rows = src.withColumn("chunk", F.explode(F.array_distinct(F.array(of(F.col("_slot") - (n - 1)), of(F.col("_slot"))))))
    return (rows.select("sat_id", "satname", "chunk", "timestamp", "seq", "latitude", "longitude", "event_time")
            .groupBy("sat_id", "satname", "chunk")
            .transformWithStateInPandas(Panes(w, s, chunk), outputStructType=WINDOW_ROW, outputMode="Update", timeMode="EventTime"))


# -- requests as of their time -----------------------------------------------

ASKED = "asked string, request_ts bigint, obs_latitude double, obs_longitude double"
SEEN = "sat_id string, satname string, latitude double, longitude double, timestamp bigint, seq bigint"
_ASKED = [c.split()[0] for c in ASKED.split(", ")]
_SEEN = [c.split()[0] for c in SEEN.split(", ")]
#: Rows of an answer's frame, about.
ANSWER_ROWS = 50_000


def _packed(f: pd.DataFrame) -> tuple[bytes]:
    t = pa.Table.from_pandas(f, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(rows, columns: list[str]) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(bytes(r[0])).read_all().to_pandas() for r in rows]
    return pd.concat(parts, ignore_index=True)[columns] if parts else pd.DataFrame(columns=columns)


def _last_of_second(f: pd.DataFrame) -> pd.DataFrame:
    """The last fix of each object and second, by object and time."""
    code = pd.factorize(f["sat_id"], use_na_sentinel=False)[0]
    ts = f["timestamp"].to_numpy(np.int64)
    order = np.lexsort((f["seq"].to_numpy(np.int64), ts, code))
    code, ts = code[order], ts[order]
    last = np.append((code[1:] != code[:-1]) | (ts[1:] != ts[:-1]), True)
    return f.iloc[order[last]]


class AsofRequests(StatefulProcessor):
    """State of (bucket, group of objects): the fixes of the bucket and the one
    before, and the bucket's requests that may still see a fix. A request is
    answered when the watermark has passed it, by a search in each object's
    times: its cost does not grow with the fixes that it could have seen."""

    def __init__(self, lookback_s: int):
        self._lookback_s = lookback_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._fixes = handle.getListState("fixes", "packed binary")
        self._asked = handle.getListState("asked", "packed binary")

    def _end(self, key) -> int:
        return (int(key[0]) + 1) * self._lookback_s * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._handle.registerTimer(self._end(key))
        fixes, asked = [], []
        for pdf in rows:
            fix = pdf["fix"].to_numpy(bool)
            if fix.any():
                fixes.append(_last_of_second(pdf.loc[fix, _SEEN]))
            if not fix.all():
                asked.append(pdf.loc[~fix, _ASKED].drop_duplicates())
        if fixes:
            self._fixes.appendValue(_packed(_last_of_second(pd.concat(fixes, ignore_index=True))))
        if asked:
            new = pd.concat(asked, ignore_index=True).drop_duplicates()
            self._asked.appendValue(_packed(new))
            self._handle.registerTimer(int(new["request_ts"].min()) * 1000 - 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        asked = _unpacked(self._asked.get(), _ASKED).drop_duplicates()
        due = asked["request_ts"].to_numpy(np.int64) * 1000 <= passed
        if due.any():
            yield from self._answers(asked[due])
        if passed >= self._end(key):                         # nothing of this bucket can come
            self._asked.clear()
            self._fixes.clear()
        elif due.any():
            left = asked[~due]
            self._asked.clear()
            if len(left):
                self._asked.appendValue(_packed(left))
                self._handle.registerTimer(int(left["request_ts"].min()) * 1000 - 1)

    def _answers(self, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        f = _unpacked(self._fixes.get(), _SEEN)
        if not len(f):
            return
        f = _last_of_second(f)
        code, ids = pd.factorize(f["sat_id"], use_na_sentinel=False)
        ts, t = f["timestamp"].to_numpy(np.int64), asked["request_ts"].to_numpy(np.int64)
        first = np.searchsorted(code, np.arange(len(ids) + 1))
        who, what, n = [], [], 0
        for a, z in zip(first[:-1], first[1:], strict=True):
            at = a + np.searchsorted(ts[a:z], t, "right") - 1
            hit = np.flatnonzero((at >= a) & (ts[np.maximum(at, a)] >= t - self._lookback_s))
            who.append(hit)
            what.append(at[hit])
            n += len(hit)
            if n >= ANSWER_ROWS or z == first[-1]:
                yield self._frame(asked.iloc[np.concatenate(who)], f.iloc[np.concatenate(what)])
                who, what, n = [], [], 0

    def _frame(self, a: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        seq = pd.array(f["seq"].to_numpy(np.int64), dtype="Int64")
        seq[f["seq"].to_numpy() == NO_SEQ] = pd.NA
        time = pd.Series(a["request_ts"].to_numpy(np.int64).astype("datetime64[s]").astype("datetime64[us]")).dt.tz_localize("UTC")
        return pd.DataFrame({
            "asked": a["asked"].to_numpy(object), "request_time": time, "request_ts": a["request_ts"].to_numpy(np.int64),
            "obs_latitude": a["obs_latitude"].to_numpy(float), "obs_longitude": a["obs_longitude"].to_numpy(float),
            "sat_id": f["sat_id"].to_numpy(object), "satname": f["satname"].to_numpy(object), "latitude": f["latitude"].to_numpy(float),
            "longitude": f["longitude"].to_numpy(float), "fix_ts": f["timestamp"].to_numpy(np.int64), "fix_seq": seq})

    def close(self) -> None:
        pass


ANSWER = ("asked string, request_time timestamp, request_ts bigint, obs_latitude double, obs_longitude double, sat_id string, "
          "satname string, latitude double, longitude double, fix_ts bigint, fix_seq bigint")


def asof_requests(asked: DataFrame, fixes: DataFrame, lookback_s: int, spread: int) -> DataFrame:
    """Rows of ``ANSWER``: the latest fix of every object as of each request, at
    most ``lookback_s`` old. ``asked`` (``ASKED`` and ``event_time``) and ``fixes``
    (``SEEN`` and ``event_time``) are watermarked streams."""
    use_rocksdb(asked.sparkSession)
    bucket = lambda c: F.floor(F.col(c) / F.lit(int(lookback_s))).cast("bigint")
    none = lambda schema, zero: [F.lit(0 if c in zero else None).cast(c_type).alias(c)
                                 for c, c_type in (x.split() for x in schema.split(", "))]
    seen = (fixes.withColumn("seq", F.coalesce("seq", F.lit(NO_SEQ)))
            .select(F.explode(F.array(bucket("timestamp"), bucket("timestamp") + 1)).alias("b"),
                    F.pmod(F.xxhash64("sat_id"), F.lit(int(spread))).alias("g"), "event_time",
                    F.lit(True).alias("fix"), *none(ASKED, ("request_ts",)), *_SEEN))
    rows = (asked.withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(int(spread) - 1).cast("bigint"))))
            .select(bucket("request_ts").alias("b"), "g", "event_time", F.lit(False).alias("fix"), *_ASKED, *none(SEEN, ("timestamp", "seq"))))
    return seen.unionByName(rows).groupBy("b", "g").transformWithStateInPandas(
        AsofRequests(int(lookback_s)), outputStructType=ANSWER, outputMode="Append", timeMode="EventTime", eventTimeColumnName="request_time")
