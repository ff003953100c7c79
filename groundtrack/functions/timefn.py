"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ column.

    ``timestampdiff`` between two NTZ values involves no zone, so the result
    is the same whatever ``spark.sql.session.timeZone`` is.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def to_event_time(epoch_s) -> Column:
    """Epoch seconds (bigint) -> TIMESTAMP, for event-time windows."""
    c = F.col(epoch_s) if isinstance(epoch_s, str) else epoch_s
    return F.timestamp_seconds(c)


def ts_to_epoch(ts) -> Column:
    """TIMESTAMP (with zone) -> epoch seconds; zone free by definition."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(c)
