"""Requests answered from the position stream itself: one query over two
watermarked inputs, without an archive.

``asof_live`` brings a stream of requests and the stream of fixes together by
event time. Both are keyed by a time bucket of the look-back and one of
``spread`` groups of objects (a request goes to all groups, a fix to its bucket
and the next), so the fixes of the current hour are spread over ``spread`` tasks,
not one. The keyed state (``keyed.AsofRequests``) holds the fixes of the look-back
and the requests, whichever side came first, and answers a request when the
watermark has passed it, that is when no fix that the request should see can
still come. Each object's fix, the latest by ``(timestamp, seq)``, is found by a
search in its times: requests are never paired with all the fixes of their hour.
``closest_live`` chains the arg-min of the distance behind it.

Both work on streams in append mode, and on batch input (the lookup of
``operators.asof``) with the same rows; fixes and requests that are late on a
stream are part of a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.functions.geo import haversine_km
from groundtrack.functions.timefn import to_event_time
from groundtrack.operators import asof
from groundtrack.params import WATERMARK
from groundtrack.streaming import keyed

#: Groups of objects that the state is spread over.
SPREAD = 16
_FIX = ("sat_id", "satname", "latitude", "longitude", "timestamp", "seq")


def asof_live(requests: DataFrame, fixes: DataFrame, lookback_s: int, watermark: str = WATERMARK,
              key: str = "request_id", spread: int = SPREAD) -> DataFrame:
    """Rows (request, object, latest fix as of the request time): the columns of
    ``asof_positions`` and ``request_time``, the event time."""
    seen = fixes.where(F.col("timestamp").isNotNull()).select(*_FIX)
    asked = requests.where(F.col("timestamp").isNotNull()).select(F.col(key), "timestamp", "obs_latitude", "obs_longitude")
    if requests.isStreaming:
        seen = seen.withColumn("event_time", to_event_time("timestamp")).withWatermark("event_time", watermark)
        asked = (asked.select(F.col(key).cast("string").alias("asked"), F.col("timestamp").alias("request_ts"), "obs_latitude", "obs_longitude",
                              to_event_time("timestamp").alias("event_time")).withWatermark("event_time", watermark))
        rows = keyed.asof_requests(asked, seen, lookback_s, spread).withColumn(key, F.col("asked").cast(requests.schema[key].dataType))
    else:
        rows = asof.asof_positions(asked.distinct(), seen, int(lookback_s), key=key).withColumn("request_time", to_event_time("request_ts"))
    return rows.select(key, "request_time", "request_ts", "obs_latitude", "obs_longitude", "sat_id", "satname", "latitude", "longitude",
                       "fix_ts", "fix_seq")


def closest_live(requests: DataFrame, fixes: DataFrame, lookback_s: int, watermark: str = WATERMARK,
                 key: str = "request_id", spread: int = SPREAD, digits: int = 2) -> DataFrame:
    """Per request the object whose as-of fix is nearest (ties: lowest
    ``sat_id``), with the columns of ``closest_satellite``."""
    located = fixes.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    rows = asof_live(requests.where(F.col("obs_latitude").isNotNull() & F.col("obs_longitude").isNotNull()), located,
                     lookback_s, watermark, key, spread)
    # a distance that is no number comes last
    rows = rows.withColumn("_d", F.coalesce(haversine_km("obs_latitude", "obs_longitude", "latitude", "longitude"), F.lit(float("nan"))))
    best = rows.groupBy("request_time", key).agg(F.min(F.struct(
        "_d", "sat_id", "satname", "latitude", "longitude", "obs_latitude", "obs_longitude", "request_ts", "fix_ts")).alias("m"))
    return best.select(key, "m.satname", "m.sat_id", "m.latitude", "m.longitude", F.round("m._d", digits).alias("distance_km"),
                       F.col("m.obs_latitude").alias("observer_lat"), F.col("m.obs_longitude").alias("observer_lon"),
                       F.col("m.request_ts").alias("timestamp"), "m.fix_ts")
