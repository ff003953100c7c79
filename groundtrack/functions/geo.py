"""Great-circle geometry as native Spark column expressions.

No Python UDF: the expression stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundtrack.params import EARTH_RADIUS_KM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between two (lat, lon) points in degrees.

    ``1 - a`` is clamped at 0: for near-antipodal points rounding can push
    ``a`` above 1, which would give NaN. A null input gives a null distance.
    """
    p1 = F.radians(_c(lat1))
    p2 = F.radians(_c(lat2))
    dphi = p2 - p1
    dlam = F.radians(_c(lon2)) - F.radians(_c(lon1))
    s1 = F.sin(dphi / 2)
    s2 = F.sin(dlam / 2)
    a = s1 * s1 + F.cos(p1) * F.cos(p2) * s2 * s2
    return F.lit(2.0 * radius_km) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(1.0) - a, F.lit(0.0))))


def geo_parts(lat, lon, prefix: str) -> list[Column]:
    """Per-point terms of the haversine formula, to compute once per point
    before a pair join instead of once per pair: latitude and longitude in
    radians and the cosine of the latitude."""
    p = F.radians(_c(lat))
    return [p.alias(f"{prefix}phi"), F.cos(p).alias(f"{prefix}cos"),
            F.radians(_c(lon)).alias(f"{prefix}lam")]


def haversine_from_parts(a: str, b: str, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance from two sets of ``geo_parts`` (prefixes ``a``,
    ``b``). Same operations as ``haversine_km``, so the same doubles."""
    s1 = F.sin((F.col(f"{b}phi") - F.col(f"{a}phi")) / 2)
    s2 = F.sin((F.col(f"{b}lam") - F.col(f"{a}lam")) / 2)
    x = s1 * s1 + F.col(f"{a}cos") * F.col(f"{b}cos") * s2 * s2
    return F.lit(2.0 * radius_km) * F.atan2(F.sqrt(x), F.sqrt(F.greatest(F.lit(1.0) - x, F.lit(0.0))))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str,
                  radius_km: float = EARTH_RADIUS_KM) -> str:
    """The same formula as SQL text (used by the oracle)."""
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    a = (f"(sin(({p2} - {p1}) / 2) * sin(({p2} - {p1}) / 2) + cos({p1}) * cos({p2}) * "
         f"sin((radians({lon2}) - radians({lon1})) / 2) * sin((radians({lon2}) - radians({lon1})) / 2))")
    return f"({2.0 * radius_km} * atan2(sqrt({a}), sqrt(greatest(1.0 - {a}, 0.0))))"
