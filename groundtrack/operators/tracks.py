"""Ground tracks from windowed positions, and the archived history path.

A track is the ordered list of window points of one object. ``tracks``
applies the retention itself, so a track holds at most about
(retain + window) / slide points whatever the data volume: the per-object
``collect_list`` is bounded by parameters, not by data.

The full history of one object is never gathered into one row:
``history_path`` returns it as rows in a distributed (range-partitioned)
sort order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.functions.sphere import unit_vector
from groundtrack.operators.windows import track_retention
from groundtrack.params import (
    EARTH_RADIUS_KM, HISTORY_SAT_ID, MAP_TITLE, MIN_TRACK_POINTS, OBSERVER, OBSERVER_NAME, OBSERVER_POPUP, PATH_POPUP, POPUP, RETAIN_S, SAT_IDS, UPDATED,
)

POINT = ("window_start", "window_end", "timestamp", "latitude", "longitude")


def allowlist(df: DataFrame, sat_ids=SAT_IDS) -> DataFrame:
    """Keep rows of the tracked objects (an ``IN`` list that Spark turns into
    an ``InSet`` and pushes to the scan when possible)."""
    return df.where(F.col("sat_id").isin(list(sat_ids)))


def tracks(windows: DataFrame, now_s, retain_s: int = RETAIN_S,
           min_points: int = MIN_TRACK_POINTS) -> DataFrame:
    """One row per object with >= ``min_points`` retained windows: its path
    ordered by window start, and the name of its first window.

    Retention is applied here (window ended at most ``retain_s`` before
    ``now_s``, and started no later than ``now_s``), so a path holds at most
    (retain + window) / slide points whatever the data volume.
    """
    now = now_s if isinstance(now_s, Column) else F.lit(int(now_s))
    kept = track_retention(windows, now, retain_s).where(F.col("window_start") <= now)
    g = kept.groupBy("sat_id").agg(
        F.array_sort(F.collect_list(F.struct(*POINT))).alias("path"),
        F.min_by("satname", "window_start").alias("satname"))
    return (g.where(F.size("path") >= min_points)
            .select("sat_id", "satname", F.size("path").alias("n_points"), "path"))


def track_points(tr: DataFrame) -> DataFrame:
    """Tracks back to rows with their 0-based position in the path."""
    return tr.select("sat_id", "satname", F.posexplode("path").alias("point_index", "p")).select(
        "sat_id", "satname", "point_index",
        *[F.col(f"p.{c}").alias(c) for c in POINT])


def track_heads(tr: DataFrame) -> DataFrame:
    """The end marker of each track: its last point."""
    last = F.element_at("path", -1)
    return tr.select("sat_id", "satname", *[last[c].alias(c) for c in POINT])


def track_extent(windows: DataFrame) -> DataFrame:
    """Earliest window start and latest window end over all objects."""
    return windows.agg(F.min("window_start").alias("oldest_window_start"),
                       F.max("window_end").alias("latest_window_end"),
                       F.count_distinct("sat_id").alias("n_satellites"))


def track_legend(windows: DataFrame) -> DataFrame:
    """One entry per object with any window: the name of its first window."""
    return windows.groupBy("sat_id").agg(
        F.min_by("satname", F.struct("window_start", "timestamp")).alias("satname"),
        F.count(F.lit(1)).alias("n_windows"))


def history_path(history: DataFrame, sat_id: str = HISTORY_SAT_ID) -> DataFrame:
    """Archived fixes of one object in time order. The predicate and the
    4-column projection reach the parquet scan; ``seq`` breaks time ties."""
    return (history.where(F.col("sat_id") == F.lit(sat_id))
            .select("satname", "latitude", "longitude", "timestamp", "seq")
            .orderBy("timestamp", "seq"))


def track_geojson(tr: DataFrame) -> DataFrame:
    """Each track as a GeoJSON Feature (LineString of [lon, lat]) plus a
    Point feature for its head, as JSON text columns."""
    coords = F.transform("path", lambda p: F.array(p["longitude"], p["latitude"]))
    props = F.struct("sat_id", "satname", F.col("n_points"))
    line = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"),
        props.alias("properties")))
    last = F.element_at("path", -1)
    head = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(last["longitude"], last["latitude"]).alias("coordinates")).alias("geometry"),
        props.alias("properties")))
    return tr.select("sat_id", "satname", line.alias("track"), head.alias("head"))


def hhmm(epoch_s) -> Column:
    """``HH:MM`` (UTC) of epoch seconds, computed without the session zone."""
    c = F.col(epoch_s) if isinstance(epoch_s, str) else epoch_s
    return F.format_string("%02d:%02d", F.floor(F.pmod(c, F.lit(86400)) / 3600).cast("int"),
                           F.floor(F.pmod(c, F.lit(3600)) / 60).cast("int"))


def date_time(epoch_s) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` (UTC) of epoch seconds, without the session zone."""
    c = F.col(epoch_s) if isinstance(epoch_s, str) else epoch_s
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c / 86400).cast("int"))
    return F.concat(day.cast("string"), F.lit(" "), hhmm(c), F.format_string(":%02d", F.pmod(c, F.lit(60)).cast("int")))


def track_labels(tr: DataFrame, windows: DataFrame) -> DataFrame:
    """Text of the map: the end-marker popup of each track
    ('<name> (ID: <id>)' and the 'HH:MM to HH:MM' window of its last point)
    and the map title over the whole extent (scalar subqueries, no join)."""
    last = F.element_at("path", -1)
    lo = windows.agg(F.min("window_start")).scalar()
    hi = windows.agg(F.max("window_end")).scalar()
    return tr.select(
        "sat_id",
        F.format_string(POPUP, F.col("satname"), F.col("sat_id")).alias("popup"),
        F.concat(hhmm(last["window_start"]), F.lit(" to "), hhmm(last["window_end"])).alias("window_label"),
        F.concat(F.lit(MAP_TITLE), hhmm(lo), F.lit(" to "), hhmm(hi)).alias("title"))


# -- geometry for maps -------------------------------------------------------

def _pairs(p) -> Column:
    return F.array(p["longitude"], p["latitude"])


def split_lines(path: str = "path") -> Column:
    """The path as lines of [longitude, latitude] that do not cross the
    antimeridian: where a step is longer than 180 degrees it goes the other way
    round, and the line ends at +/-180 and goes on at the other side, at the
    latitude between. A path without points gives no line."""
    def step(acc, p):
        d = p["longitude"] - acc["lon"]
        span, to_side = 360 - F.abs(d), 180 - F.abs(acc["lon"])
        side = F.when(d > 0, F.lit(-180.0)).otherwise(F.lit(180.0))
        at = acc["lat"] + F.when(span > 0, to_side / span).otherwise(F.lit(0.0)) * (p["latitude"] - acc["lat"])
        over = F.abs(d) > 180
        return F.struct(
            F.when(over, F.concat(acc["done"], F.array(F.concat(acc["line"], F.array(F.array(side, at)))))).otherwise(acc["done"]).alias("done"),
            F.when(over, F.array(F.array(-side, at), _pairs(p))).otherwise(F.concat(acc["line"], F.array(_pairs(p)))).alias("line"),
            p["longitude"].alias("lon"), p["latitude"].alias("lat"))

    first = F.element_at(path, 1)
    begin = F.struct(F.array().cast("array<array<array<double>>>").alias("done"), F.array(_pairs(first)).alias("line"),
                     first["longitude"].alias("lon"), first["latitude"].alias("lat"))
    whole = F.aggregate(F.slice(path, 2, F.size(path)), begin, step, lambda a: F.concat(a["done"], F.array(a["line"])))
    return F.when(F.size(path) > 0, whole).otherwise(F.array().cast("array<array<array<double>>>"))


def _cross(a, b) -> tuple:
    return (a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def _dot(v: tuple, p) -> Column:
    return v[0] * p["x"] + v[1] * p["y"] + v[2] * p["z"]


def _angle(a, b) -> Column:
    d = [a[c] - b[c] for c in "xyz"]
    return 2 * F.asin(F.least(F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]) / 2, F.lit(1.0)))


def off_line(a, b, p) -> Column:
    """Angle between a point and the great-circle segment from ``a`` to ``b``
    (structs with the unit vector ``x``, ``y``, ``z``)."""
    n = _cross(a, b)
    size = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
    # beside the segment: on b's side of a, and on a's side of b
    beside = (_dot(n, _named(_cross(a, p))) >= 0) & (_dot(n, _named(_cross(p, b))) >= 0) & (size > 1e-12)
    return F.when(beside, F.asin(F.least(F.abs(_dot(n, p)) / size, F.lit(1.0)))).otherwise(F.least(_angle(a, p), _angle(b, p)))


def _named(v: tuple) -> dict:
    return dict(zip("xyz", v, strict=True))


def simplify(tr: DataFrame, tolerance_km: float, radius_km: float = EARTH_RADIUS_KM) -> DataFrame:
    """Tracks with as few of their points as one pass needs so that every point
    left out lies within ``tolerance_km`` of the great-circle segment that
    replaces it. The first and the last point stay. Points wait while a segment
    from the last kept point covers them all; the last of them is kept when a
    new point breaks that. A path holds a bounded number of points (``tracks``)."""
    limit = F.lit(float(tolerance_km) / radius_km)
    point = lambda p: F.struct(*[p[c].alias(c) for c in POINT], *unit_vector(p["latitude"], p["longitude"]))

    def step(acc, p):
        from_ = F.element_at(acc["kept"], -1)
        covered = F.forall(acc["wait"], lambda w: off_line(from_, p, w) <= limit)
        return F.struct(F.when(covered, acc["kept"]).otherwise(F.concat(acc["kept"], F.slice(acc["wait"], -1, 1))).alias("kept"),
                        F.when(covered, F.concat(acc["wait"], F.array(p))).otherwise(F.array(p)).alias("wait"))

    pts = F.transform("path", point)
    nothing = F.slice(pts, 1, 0)
    kept = F.aggregate(F.slice(pts, 2, F.size("path")), F.struct(F.slice(pts, 1, 1).alias("kept"), nothing.alias("wait")), step,
                       lambda a: F.concat(a["kept"], F.when(F.size(a["wait"]) > 0, F.slice(a["wait"], -1, 1)).otherwise(nothing)))
    kept = F.transform(kept, lambda p: F.struct(*[p[c].alias(c) for c in POINT]))
    return tr.withColumn("path", kept).withColumn("n_points", F.size("path"))


def track_lines(tr: DataFrame) -> DataFrame:
    """Each track as a GeoJSON Feature with a MultiLineString that is cut at the
    antimeridian (``track``), its lines as arrays, and the path's popup."""
    props = F.struct("sat_id", "satname", "n_points")
    out = tr.select("*", split_lines().alias("lines"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"),
                                 F.struct(F.lit("MultiLineString").alias("type"), F.col("lines").alias("coordinates")).alias("geometry"),
                                 props.alias("properties")))
    return out.select("sat_id", "satname", "n_points", "lines", F.format_string(PATH_POPUP, F.col("satname")).alias("popup"), feature.alias("track"))


def map_features(tr: DataFrame, windows: DataFrame, now_s, observer: tuple[float, float] = OBSERVER, place: str = OBSERVER_NAME) -> DataFrame:
    """Everything a map draws, one row a feature: the path of each track (cut at
    the antimeridian), the marker at its end, and the observer's; with ``popup``
    text, ``geometry`` as GeoJSON, and the map's ``title`` and ``updated`` line
    (``now_s`` in UTC). No window, no map."""
    now = now_s if isinstance(now_s, Column) else F.lit(int(now_s))
    geometry = lambda kind, coords: F.to_json(F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")))
    last = F.element_at("path", -1)
    paths = tr.select(F.lit("path").alias("kind"), "sat_id", "satname", F.format_string(PATH_POPUP, F.col("satname")).alias("popup"),
                      geometry("MultiLineString", split_lines()).alias("geometry"))
    heads = tr.select(F.lit("head").alias("kind"), "sat_id", "satname",
                      F.concat(F.format_string(POPUP, F.col("satname"), F.col("sat_id")), F.lit("\nWindow: "), hhmm(last["window_start"]),
                               F.lit(" to "), hhmm(last["window_end"])).alias("popup"),
                      geometry("Point", F.array(last["longitude"], last["latitude"])).alias("geometry"))
    extent = windows.agg(F.min("window_start").alias("lo"), F.max("window_end").alias("hi")).where("lo is not null")
    seen = extent.select(F.lit("observer").alias("kind"), F.lit(None).cast("string").alias("sat_id"), F.lit(None).cast("string").alias("satname"),
                         F.lit(OBSERVER_POPUP % place).alias("popup"),
                         geometry("Point", F.array(F.lit(float(observer[1])), F.lit(float(observer[0])))).alias("geometry"))
    title = F.concat(F.lit(MAP_TITLE), hhmm(extent.select("lo").scalar()), F.lit(" to "), hhmm(extent.select("hi").scalar()))
    return paths.unionByName(heads).unionByName(seen).select("*", title.alias("title"), F.concat(F.lit(UPDATED), date_time(now)).alias("updated"))
