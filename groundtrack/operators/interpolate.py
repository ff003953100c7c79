"""Positions at common instants, by great-circle interpolation, and coverage
overlap of objects that do not report at the same second.

Equal timestamps are needed to pair fixes as they are; fixes one second apart
give no pair. ``positions_at`` puts every object on one time grid: between two
fixes of an object that are at most ``max_gap_s`` apart it moves along the great
circle with even speed, so its position at each multiple of ``step_s`` in
between is known. Pairs are then built per instant as ever.

Plan: the next fix of each fix by a window per (object, time chunk), with the
fixes of the following ``max_gap_s`` read along as context, so one object's
history is spread over tasks; instants are made by ``sequence`` from a fix to
the next (at most ``max_gap_s / step_s`` of them); all trigonometry is native.
Of several fixes in one second the one with the greatest ``seq`` holds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundtrack.functions.ordering import order_key
from groundtrack.functions.sphere import unit_vector
from groundtrack.operators import overlap
from groundtrack.params import COVERAGE_RADIUS_KM, MOTION_CHUNK_S

_FIX = ("satname", "latitude", "longitude")


def _one_a_second(fixes: DataFrame) -> DataFrame:
    """The last fix of each (object, second)."""
    f = fixes.where(F.col("timestamp").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return (f.withColumn("_k", order_key()).groupBy("sat_id", "timestamp")
            .agg(*[F.max_by(c, "_k").alias(c) for c in _FIX]))


def positions_at(fixes: DataFrame, step_s: int, max_gap_s: int, chunk_s: int = MOTION_CHUNK_S) -> DataFrame:
    """Rows (sat_id, satname, timestamp, latitude, longitude, exact): where each
    object was at the multiples of ``step_s`` that lie between two of its fixes
    at most ``max_gap_s`` apart, and at those that it reported at itself
    (``exact``). Two fixes on opposite sides of the Earth have no one way
    between them and give nothing; the name is that of the earlier fix."""
    step, gap, C = int(step_s), int(max_gap_s), max(int(chunk_s), int(max_gap_s))
    if step <= 0 or gap <= 0:
        raise ValueError("step_s and max_gap_s must be positive")
    f = _one_a_second(fixes).withColumn("_c", F.floor(F.col("timestamp") / F.lit(C)).cast("bigint"))
    at_start = F.col("timestamp") <= F.col("_c") * F.lit(C) + F.lit(gap)
    own = F.array(F.struct(F.col("_c").alias("c"), F.lit(True).alias("own")))
    with_context = F.concat(own, F.array(F.struct((F.col("_c") - 1).alias("c"), F.lit(False).alias("own"))))
    f = f.select("*", F.explode(F.when(at_start, with_context).otherwise(own)).alias("_to"))
    f = f.select("sat_id", *_FIX, "timestamp", F.col("_to.c").alias("_c"), F.col("_to.own").alias("_own"),
                 *unit_vector("latitude", "longitude", "a_"))
    w = Window.partitionBy("sat_id", "_c").orderBy("timestamp")
    nxt = F.lead(F.struct("timestamp", *[F.col(f"a_{a}").alias(a) for a in "xyz"])).over(w)
    f = f.withColumn("_n", nxt).where("_own")
    t0, t1 = F.col("timestamp"), F.col("_n.timestamp")
    follows = F.coalesce(t1 - t0 <= F.lit(gap), F.lit(False))
    first = F.ceil(t0 / F.lit(step)).cast("bigint") * F.lit(step)
    f = f.withColumns({"_first": first, "_last": F.when(follows, t1 - 1).otherwise(t0)}).where("_first <= _last")
    f = f.withColumn("_t", F.explode(F.sequence("_first", "_last", F.lit(step).cast("bigint"))))
    # the angle between the fixes from the straight line, exact where they are near
    side = [F.col(f"_n.{a}") - F.col(f"a_{a}") for a in "xyz"]
    line = F.sqrt(side[0] * side[0] + side[1] * side[1] + side[2] * side[2])
    f = f.withColumn("_w", F.lit(2.0) * F.asin(F.least(line / 2, F.lit(1.0))))
    share = (F.col("_t") - t0) / (t1 - t0)
    still = F.col("_w") < 1e-12
    ka = F.when(still, 1 - share).otherwise(F.sin((1 - share) * F.col("_w")) / F.sin("_w"))
    kb = F.when(still, share).otherwise(F.sin(share * F.col("_w")) / F.sin("_w"))
    f = f.withColumn("_exact", F.col("_t") == t0).where(F.col("_exact") | (F.col("_w") < math.pi - 1e-6))
    p = f.select("sat_id", "satname", F.col("_t"), "_exact", "latitude", "longitude",
                 *[F.when(~F.col("_exact"), ka * F.col(f"a_{a}") + kb * F.col(f"_n.{a}")).alias(a) for a in "xyz"])
    lat = F.degrees(F.atan2(F.col("z"), F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))))
    lon = F.degrees(F.atan2(F.col("y"), F.col("x")))
    return p.select("sat_id", "satname", F.col("_t").alias("timestamp"), F.when(F.col("_exact"), F.col("latitude")).otherwise(lat).alias("latitude"),
                    F.when(F.col("_exact"), F.col("longitude")).otherwise(lon).alias("longitude"), F.col("_exact").alias("exact"))


def overlap_within(fixes: DataFrame, step_s: int, max_gap_s: int, radius_km: float = COVERAGE_RADIUS_KM,
                   digits: int | None = 2, only_overlapping: bool = False) -> DataFrame:
    """Coverage overlap (``coverage_overlap``) of all objects at the multiples of
    ``step_s``, each at its interpolated position; degrees rounded to 5 places."""
    p = positions_at(fixes, step_s, max_gap_s)
    out = overlap.pairs(p, ["timestamp"], radius_km, digits=digits, only_overlapping=only_overlapping)
    return out.withColumns({c: F.round(c, 5) for c in ("lat1", "lon1", "lat2", "lon2")})
