"""Latest fix per object and the display snapshot.

``latest_positions`` replaces a driver-side "last arrival wins" cache: a
grouped ``max_by`` on one exact packed ``(timestamp, seq)`` key, hash-based
over all fixes. Spark aggregates partially in every map task before the
shuffle, so a hot object sends one row per task. (The completeness gate of
a request's cache is ``asof.satellites_in_view``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from groundtrack.functions.ordering import order_key

ORDER = ("timestamp", "seq")


def latest_positions(fixes: DataFrame, key: str = "sat_id",
                     order: tuple[str, ...] = ORDER, two_step: bool = True) -> DataFrame:
    """One row per ``key``: the fix with the greatest ``order`` tuple.

    Two steps so the big one is a hash aggregate: over all fixes, group by
    the key *and* the string columns (names; fixed-width buffers only) and
    take the numeric columns with ``max_by`` on the packed order key; then,
    over that small result (one row per key and name), keep the latest row
    per key. ``two_step=False`` is one aggregate, for streams (a streaming
    query in complete mode allows a single aggregation; its state is one
    row per key).
    """
    rest = [c for c in fixes.columns if c != key]
    k = order_key(*order) if len(order) == 2 else F.struct(*order)
    if not two_step:
        one = fixes.withColumn("_k", k).groupBy(key).agg(F.max_by(F.struct(*rest), "_k").alias("_r"))
        return one.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    strings = [c for c in rest if isinstance(fixes.schema[c].dataType, StringType)]
    per_name = (fixes.withColumn("_k", k).groupBy(key, *strings)
                .agg(*[F.max_by(c, "_k").alias(c) for c in rest if c not in strings],
                     F.max("_k").alias("_k")))
    best = per_name.groupBy(key).agg(F.max_by(F.struct(*rest), "_k").alias("_r"))
    return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def snapshot(fixes: DataFrame) -> DataFrame:
    """Current position table for display: lat/lon 4 dp, az/el 2 dp."""
    lp = latest_positions(fixes)
    return lp.select(
        "satname", "sat_id",
        F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"),
        F.round("azimuth", 2).alias("azimuth"), F.round("elevation", 2).alias("elevation"),
        "timestamp")
