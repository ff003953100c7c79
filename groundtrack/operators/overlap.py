"""Coverage overlap of object pairs seen at the same instant.

Semantics: every unordered pair of fixes with equal ``timestamp`` (pair
order by string ``sat_id1 < sat_id2``), their great-circle distance, whether
the two coverage discs intersect (``distance < 2r``, strict) and by how
much (``2r - distance``, else 0.0). All pairs are reported, overlapping or
not: the pair list *is* the answer, so its size is n(n-1)/2 per instant.

Plan: a sort-merge equi-join on ``timestamp`` with the ``<`` as a residual
predicate (never a nested loop, never a broadcast of the fix table, which
grows with the data). Per-point trigonometry is computed before the join,
once per fix. A hot instant is split across tasks by AQE's skew-join
handling. The optional per-instant gate is a grouped count and a semi-join
on the same key.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.functions import sphere
from groundtrack.functions.geo import geo_parts, haversine_from_parts
from groundtrack.params import COVERAGE_RADIUS_KM, EARTH_RADIUS_KM

POINT = ["sat_id", "satname", "latitude", "longitude"]


def complete_instants(fixes: DataFrame, required: int, key: str = "timestamp") -> DataFrame:
    """Keep fixes of instants at which exactly ``required`` objects report.

    A grouped distinct count (partial aggregation per task) and a semi-join
    on the same key.
    """
    ok = (fixes.groupBy(key).agg(F.count_distinct("sat_id").alias("_n"))
          .where(F.col("_n") == required).select(key))
    return fixes.join(ok, key, "left_semi")


#: Cells along the reach of a disc: finer cells fit the disc better, and copy more.
CELLS_PER_REACH = 2
#: Narrowest cells, as a share of the Earth's radius (64 m): below, only copies are won.
MIN_CELL = 1e-5
#: Objects that one meets in its latitude bands from which on cells are worth their copies.
CROWDED = 64


def in_cells(a: DataFrame, b: DataFrame, reach: float, width: float) -> tuple[DataFrame, DataFrame]:
    """The two sides of a pair join with their cells: ``a`` once for each cell
    within ``reach``, ``b`` in its own."""
    a = sphere.copied_within(a, "p_", reach, width)
    return a, b.withColumns({f"d_{x}": sphere.cell(f"q_{x}", width) for x in sphere.AXES})


def gathered(points: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Each pair of a key, once, as the join of ``pairs`` gives it: the points of
    a key are gathered into a list, in the order of ``sat_id``, and each meets
    those after it. Without a join, pairs stay in the partition of their points
    where these are partitioned by some of the keys; a list has all points of a key."""
    point = F.struct("sat_id", *[c for c in cols if c != "sat_id"], *geo_parts("latitude", "longitude", ""))
    known = reduce(and_, [F.col(c).isNotNull() for c in (*keys, "sat_id")])
    lists = points.where(known).groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("_l"))
    one = lists.select(*keys, "_l", F.posexplode("_l").alias("_n", "_a"))
    both = (one.select(*keys, "_a", F.explode(F.slice("_l", F.col("_n") + 2, F.size("_l"))).alias("_b"))
            .where(F.col("_a.sat_id") < F.col("_b.sat_id")))
    return both.select(*[F.col(k).alias(f"{k}_a") for k in keys], *[F.col(f"_{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in cols],
                       *[F.col(f"_{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in ("phi", "cos", "lam")])


def pairs(points: DataFrame, keys: list[str], radius_km: float = COVERAGE_RADIUS_KM,
          earth_radius_km: float = EARTH_RADIUS_KM, digits: int | None = 2,
          time_col: str = "timestamp", keep: tuple[str, ...] = (), hint: str | None = "merge",
          only_overlapping: bool = False, objects: int | None = None, gather: bool = False) -> DataFrame:
    """Unordered pairs of ``points`` (sat_id, satname, latitude, longitude)
    that agree on ``keys``, with distance, overlap flag and depth.

    ``time_col`` becomes the pair's ``timestamp``; ``keep`` lists key columns
    to carry through. ``only_overlapping`` adds a place to the key, one side
    being copied to all places that its disc reaches, so that each candidate pair
    is built exactly once, far pairs never, and a hot key is split by place. With
    many objects (``objects``; counted approximately if not given) a place is a
    cell on the unit sphere: two discs only meet if the straight line between
    their centres is shorter than that of ``2r`` on the ground
    (``sphere.copied_within``). With few, it is a latitude band 2r/R wide, which
    needs fewer copies. The angle between the two is part of the join condition,
    so what leaves the join is the answer but for rounding; results do not depend
    on the kind of place. ``gather`` pairs the points of a key in a list (see
    ``gathered``) and not by a join; it makes all pairs, overlapping or not.
    """
    cols = list(dict.fromkeys([*keys, time_col, *keep, *POINT]))
    if gather and only_overlapping:
        raise ValueError("gather makes all pairs")
    a = points.select(*[F.col(c).alias(f"{c}_a") for c in cols], *geo_parts("latitude", "longitude", "a_"))
    b = points.select(*[F.col(c).alias(f"{c}_b") for c in cols], *geo_parts("latitude", "longitude", "b_"))
    cond = [F.col(f"{k}_a") == F.col(f"{k}_b") for k in keys] + [F.col("sat_id_a") < F.col("sat_id_b")]
    reach = 2.0 * radius_km
    if only_overlapping:
        angle = min(math.pi, reach / earth_radius_km)
        line = sphere.chord(angle) * (1 + 1e-9) + 1e-9
        a = a.select("*", *sphere.unit_vector("latitude_a", "longitude_a", "p_"))
        b = b.select("*", *sphere.unit_vector("latitude_b", "longitude_b", "q_"))
        # as wide as the largest latitude difference of an overlapping pair, and a hair
        band_deg = math.degrees(angle) * (1 + 1e-9) + 1e-9
        if objects is None:
            objects = points.agg(F.approx_count_distinct("sat_id")).first()[0]
        if objects * min(1.0, 3 * band_deg / 180) > CROWDED:
            a, b = in_cells(a, b, line, max(line / CELLS_PER_REACH, MIN_CELL))
            cond += [F.col(f"c_{x}") == F.col(f"d_{x}") for x in sphere.AXES]
        else:
            band = lambda c: F.floor((F.col(c) + 90) / F.lit(band_deg)).cast("int")
            a = a.withColumn("_band", F.explode(F.array(band("latitude_a") - 1, band("latitude_a"), band("latitude_a") + 1)))
            b = b.withColumn("_band", band("latitude_b"))
            cond += [a["_band"] == b["_band"], F.abs(F.col("latitude_a") - F.col("latitude_b")) < F.lit(band_deg)]
        dot = sum((F.col(f"p_{x}") * F.col(f"q_{x}") for x in sphere.AXES), F.lit(0.0))
        cond.append(dot > F.lit(math.cos(angle) - 1e-9))
    if gather:
        joined = gathered(points, keys, [c for c in cols if c not in keys])
    else:
        joined = a.join(b.hint(hint) if hint else b, reduce(and_, cond))
    p = joined.withColumn("_d", haversine_from_parts("a_", "b_", earth_radius_km))
    if only_overlapping:
        p = p.where(F.col("_d") < F.lit(reach))
    ov = F.col("_d") < F.lit(reach)
    depth = F.when(ov, F.lit(reach) - F.col("_d")).otherwise(F.lit(0.0))
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return p.select(
        *[F.col(f"{k}_a").alias(k) for k in keep],
        F.col(f"{time_col}_a").alias("timestamp"), rnd(F.col("_d")).alias("distance_km"),
        ov.alias("overlap"), rnd(depth).alias("overlap_km"),
        F.col("satname_a").alias("satname1"), F.col("satname_b").alias("satname2"),
        F.col("sat_id_a").alias("sat_id1"), F.col("sat_id_b").alias("sat_id2"),
        F.col("latitude_a").alias("lat1"), F.col("longitude_a").alias("lon1"),
        F.col("latitude_b").alias("lat2"), F.col("longitude_b").alias("lon2"))


def coverage_overlap(fixes: DataFrame, radius_km: float = COVERAGE_RADIUS_KM,
                     required_satellites: int | None = None,
                     earth_radius_km: float = EARTH_RADIUS_KM,
                     digits: int | None = 2, only_overlapping: bool = False,
                     objects: int | None = None) -> DataFrame:
    """Pairs at equal timestamps with distance, overlap flag and depth.

    ``required_satellites`` reproduces the original gate (answer only when
    exactly that many objects are present); None means no gate.
    ``digits`` rounds the two km columns (None keeps full precision).
    ``only_overlapping`` returns just the overlapping pairs, built through
    latitude bands or cells on the sphere (see ``pairs``, also for ``objects``).
    """
    keyed = fixes.select("timestamp", *POINT)
    if required_satellites is not None:
        keyed = complete_instants(keyed, required_satellites)
    return pairs(keyed, ["timestamp"], radius_km, earth_radius_km, digits,
                 only_overlapping=only_overlapping, objects=objects)
