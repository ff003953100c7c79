"""What the streaming jobs did, and keeping them running.

``observed`` attaches counts to a stream of parsed rows; they are computed while
the rows pass, and arrive with the progress of each micro-batch. ``Supervisor``
is a query listener that adds them up per query, with the rows that came behind
the watermark, and keeps the last batches. ``keep_running`` starts a query again
from its checkpoint when it fails.
"""

from __future__ import annotations

import threading
import time
from collections import defaultdict, deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Micro-batches remembered per query.
KEPT = 100


def observed(rows: DataFrame, name: str, **counts: Column) -> DataFrame:
    """``rows`` with counts per micro-batch under ``name``: all rows, those with
    a ``reject_reason`` (where there is that column), and one per condition."""
    what = [F.count(F.lit(1)).alias("n_rows")]
    if "reject_reason" in rows.columns:
        what.append(F.count("reject_reason").alias("n_rejected"))
    return rows.observe(name, *what, *(F.count_if(c).alias(k) for k, c in counts.items()))


class Supervisor(StreamingQueryListener):
    """Counts of all queries of a session, by query name (its id where it has none)."""

    def __init__(self, kept: int = KEPT):
        self._lock, self._names = threading.Lock(), {}
        self._totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self._last: dict[str, deque] = defaultdict(lambda: deque(maxlen=kept))

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)
            self._totals[self._names[str(event.id)]]["starts"] += 1

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = {"input_rows": p.numInputRows, "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators)}
        for row in (p.observedMetrics or {}).values():
            counts |= {k: int(v) for k, v in row.asDict().items() if v is not None}
        with self._lock:
            name = p.name or str(p.id)
            for k, v in counts.items():
                self._totals[name][k] += v
            self._totals[name]["batches"] += 1
            self._last[name].append({"batch_id": p.batchId, "ms": p.batchDuration, **counts})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._totals[self._names.get(str(event.id), str(event.id))]["failures"] += int(event.exception is not None)

    def totals(self) -> dict[str, dict[str, int]]:
        with self._lock:
            return {k: dict(v) for k, v in self._totals.items()}

    def batches(self, name: str) -> list[dict]:
        with self._lock:
            return list(self._last[name])


class supervised:
    """``with supervised(spark) as s``: a supervisor that listens meanwhile. At
    the end all progress that Spark has sent by then is in."""

    def __init__(self, spark: SparkSession, kept: int = KEPT):
        self._spark, self.supervisor = spark, Supervisor(kept)

    def __enter__(self) -> Supervisor:
        self._spark.streams.addListener(self.supervisor)
        return self.supervisor

    def __exit__(self, *exc) -> None:
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self._spark.streams.removeListener(self.supervisor)


def keep_running(start: Callable[[], StreamingQuery], restarts: int = 3, pause_s: float = 1.0,
                 told: Callable[[Exception], None] | None = None) -> StreamingQuery:
    """Run a query to its end, and start it again from its checkpoint when it
    fails, at most ``restarts`` times without progress in between and with pauses
    that double. Returns the query that ended well; raises the last failure."""
    left, pause, best = restarts, pause_s, -1
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except Exception as e:  # noqa: BLE001 - whatever ended the query
            done = (q.lastProgress or {}).get("batchId", -1)
            if done > best:
                left, pause, best = restarts, pause_s, done
            if not left:
                raise
            if told:
                told(e)
            time.sleep(pause)
            left, pause = left - 1, 2 * pause
