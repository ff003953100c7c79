"""Points as directions on the unit sphere, and cubic cells around them.

Latitude and longitude make poor join keys: bands let all longitudes meet, and
cells of degrees shrink to nothing at the poles. The cells here are cubes of one
width in space; a point lies in one of them wherever it is, and two points whose
straight-line distance (chord) is at most the width lie in the same or in
neighbouring cubes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def unit_vector(lat, lon, prefix: str = "") -> list[Column]:
    """``x``, ``y``, ``z`` of a point in degrees."""
    c = lambda v: F.col(v) if isinstance(v, str) else v
    p, q = F.radians(c(lat)), F.radians(c(lon))
    return [(F.cos(p) * F.cos(q)).alias(f"{prefix}x"), (F.cos(p) * F.sin(q)).alias(f"{prefix}y"), F.sin(p).alias(f"{prefix}z")]


def chord(angle: float) -> float:
    """Straight-line distance of two directions ``angle`` radians apart."""
    return 2.0 * math.sin(min(math.pi, max(0.0, angle)) / 2.0)


def chord_of(angle: Column) -> Column:
    return F.lit(2.0) * F.sin(F.least(angle, F.lit(math.pi)) / 2)


def cell(axis: str, width: float) -> Column:
    """Number of the cell along one axis."""
    return F.floor((F.col(axis) + 1) / F.lit(width)).cast("int")


def cells(prefix: str, width: float) -> dict[str, Column]:
    """``c_x``, ``c_y``, ``c_z`` of the point with ``prefix``."""
    return {f"c_{a}": cell(prefix + a, width) for a in AXES}


def _copied(df: DataFrame, prefix: str, n: int, width: float, reach: float | None) -> DataFrame:
    """Rows once for each cell within ``n`` steps along every axis that the sphere
    passes through and, with ``reach``, that lies within this chord of the point;
    ``c_x``, ``c_y``, ``c_z`` name it. One axis after the other, so that what is
    out of reach is not copied further."""
    keep = df.columns
    out = df.withColumns({"_d": F.lit(0.0), "_near": F.lit(0.0), "_far": F.lit(0.0)})
    for a in AXES:
        point, low = F.col(prefix + a), F.col("_low")
        high = low + F.lit(width)
        out = out.withColumn("_i", F.explode(F.array(*[F.lit(i) for i in range(-n, n + 1)])))
        out = out.withColumn(f"c_{a}", cell(prefix + a, width) + F.col("_i"))
        out = out.withColumn("_low", F.col(f"c_{a}") * F.lit(width) - 1)
        gap = F.greatest(low - point, point - high, F.lit(0.0))
        nearest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(low * low, high * high))
        out = out.withColumns({"_d": F.col("_d") + gap * gap, "_near": F.col("_near") + nearest, "_far": F.col("_far") + F.greatest(low * low, high * high)})
        out = out.where(F.col("_near") <= 1 + 1e-9)
        if reach is not None:
            out = out.where(F.col("_d") <= reach * reach * (1 + 1e-9) + 1e-12)
    return out.where(F.col("_far") >= 1 - 1e-9).select(*keep, *(f"c_{a}" for a in AXES))


def copied_within(df: DataFrame, prefix: str, reach: float, width: float) -> DataFrame:
    """Rows once for each cell within the chord ``reach`` of their point."""
    return _copied(df, prefix, math.ceil(reach / width), width, reach)


def copied_to_block(df: DataFrame, prefix: str, width: float) -> DataFrame:
    """Rows once for their point's cell and each neighbour on the sphere."""
    return _copied(df, prefix, 1, width, None)


def clearance(prefix: str, width: float) -> Column:
    """How far a point is from anything outside its block of cells, at least."""
    sides = []
    for a in AXES:
        low = (cell(prefix + a, width) - 1) * F.lit(width) - 1
        sides += [F.col(prefix + a) - low, low + F.lit(3 * width) - F.col(prefix + a)]
    return F.least(*sides)
