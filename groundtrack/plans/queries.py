"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables (through the views of ``groundtrack.sources.fixtures``). Computed
doubles are rounded (km, km/h: 2 dp; degrees: 5 dp) and every column is
named, so the SQL oracle of ``groundtrack.plans.oracle`` can match them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.functions.geo import haversine_km
from groundtrack.operators import asof, codecs, ingest, interpolate, latest, motion, overlap, tracks as trk, windows
from groundtrack.params import OBSERVER, SAT_IDS
from groundtrack.schemas import CLOSEST_RESPONSE, MOTION_RESPONSE, OVERLAP_ITEM, POSITION, REQUEST
from groundtrack.plans.streams import STREAM_QUERIES
from groundtrack.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --- positions, distance -----------------------------------------------------

@register("coverage_overlap")
def q_coverage_overlap(spark, sf_dir):
    return overlap.coverage_overlap(fx.ticks(spark, sf_dir))


@register("coverage_overlap_hits")
def q_coverage_overlap_hits(spark, sf_dir):
    """Only the overlapping pairs (latitude-band join), 50 objects per poll."""
    return overlap.coverage_overlap(fx.ticks_n(spark, sf_dir, 50), only_overlapping=True)


@register("coverage_overlap_gated")
def q_coverage_overlap_gated(spark, sf_dir):
    """Gate on the object count: with 7 objects, only complete polls pair up
    (the last, partial poll is dropped)."""
    return overlap.coverage_overlap(fx.ticks_n(spark, sf_dir, 7), required_satellites=7)


@register("coverage_overlap_within")
def q_coverage_overlap_within(spark, sf_dir):
    """Objects that report at different seconds, paired where they are every ten
    minutes between fixes at most an hour apart."""
    return interpolate.overlap_within(fx.irregular(spark, sf_dir), step_s=600, max_gap_s=3600)


@register("haversine_pairs")
def q_haversine_pairs(spark, sf_dir):
    t = fx.ticks(spark, sf_dir)
    lat, lon = OBSERVER
    return t.select("sat_id", "seq", "timestamp",
                    F.round(haversine_km(F.lit(lat), F.lit(lon), "latitude", "longitude"), 2)
                    .alias("distance_km"))


@register("latest_positions")
def q_latest_positions(spark, sf_dir):
    return latest.latest_positions(fx.irregular(spark, sf_dir))


@register("snapshot")
def q_snapshot(spark, sf_dir):
    return latest.snapshot(fx.irregular(spark, sf_dir))


def _choice(spark, sf_dir, c):
    return fx.requests(spark, sf_dir).where(F.col("choice_id") == c)


@register("asof_positions")
def q_asof_positions(spark, sf_dir):
    return asof.asof_positions(_choice(spark, sf_dir, 3), fx.irregular(spark, sf_dir))


@register("asof_positions_1h")
def q_asof_positions_1h(spark, sf_dir):
    """The bounded form: fixes older than an hour are not seen."""
    return asof.asof_positions(_choice(spark, sf_dir, 3), fx.irregular(spark, sf_dir), lookback_s=3600)


@register("closest_satellite_1h")
def q_closest_satellite_1h(spark, sf_dir):
    return asof.closest_satellite(_choice(spark, sf_dir, 3), fx.irregular(spark, sf_dir), lookback_s=3600)


@register("closest_satellite")
def q_closest_satellite(spark, sf_dir):
    return asof.closest_satellite(_choice(spark, sf_dir, 3), fx.irregular(spark, sf_dir))


@register("closest_many")
def q_closest_many(spark, sf_dir):
    """200 objects, every request as of a poll: cells on the sphere, in rounds."""
    poll = F.lit(fx.BASE_EPOCH) + F.expr("request_id div 500") * fx.POLL_S
    return asof.closest_satellite(fx.requests(spark, sf_dir).withColumn("timestamp", poll), fx.ticks_n(spark, sf_dir, 200))


@register("closest_satellite_grid")
def q_closest_satellite_grid(spark, sf_dir):
    """Same answers through a coarser grid."""
    return asof.closest_satellite(_choice(spark, sf_dir, 3), fx.irregular(spark, sf_dir), cell_deg=30)


@register("snapshot_complete")
def q_snapshot_complete(spark, sf_dir):
    return asof.satellites_in_view(_choice(spark, sf_dir, 2), fx.irregular(spark, sf_dir),
                                   required=len(SAT_IDS))


@register("overlap_answers")
def q_overlap_answers(spark, sf_dir):
    return asof.overlap_answers(_choice(spark, sf_dir, 2), fx.irregular(spark, sf_dir))


# --- motion ------------------------------------------------------------------

@register("motion_vectors")
def q_motion_vectors(spark, sf_dir):
    return motion.motion_vectors(fx.ticks(spark, sf_dir))


@register("motion_vectors_irregular")
def q_motion_vectors_irregular(spark, sf_dir):
    return motion.motion_vectors(fx.irregular(spark, sf_dir))


@register("motion_top5")
def q_motion_top5(spark, sf_dir):
    v = motion.motion_vectors(fx.ticks(spark, sf_dir))
    v = v.withColumn("batch", F.floor(F.col("timestamp") / 90).cast("bigint"))
    return motion.motion_top(v, "batch").withColumn("rank", F.col("rank").cast("bigint"))


@register("motion_answers")
def q_motion_answers(spark, sf_dir):
    v = motion.motion_vectors(fx.irregular(spark, sf_dir))
    return asof.motion_answers(_choice(spark, sf_dir, 1), v)


# --- windows and tracks ------------------------------------------------------

@register("sliding_positions")
def q_sliding_positions(spark, sf_dir):
    return windows.sliding_positions(fx.irregular(spark, sf_dir))


@register("track_retention")
def q_track_retention(spark, sf_dir):
    f = fx.irregular(spark, sf_dir)
    now = windows.data_now(f)
    return windows.track_retention(windows.sliding_positions(windows.recent_fixes(f, now)), now)


def _ticks_windows(spark, sf_dir):
    f = fx.ticks(spark, sf_dir)
    now = windows.data_now(f)
    return windows.sliding_positions(windows.recent_fixes(f, now)), now


def _retained_ticks(spark, sf_dir):
    w, now = _ticks_windows(spark, sf_dir)
    return windows.track_retention(w, now)


def _ticks_tracks(spark, sf_dir):
    return trk.tracks(*_ticks_windows(spark, sf_dir))


@register("tracks")
def q_tracks(spark, sf_dir):
    pts = trk.track_points(_ticks_tracks(spark, sf_dir))
    return pts.withColumn("point_index", F.col("point_index").cast("bigint"))


@register("track_heads")
def q_track_heads(spark, sf_dir):
    return trk.track_heads(_ticks_tracks(spark, sf_dir))


@register("track_extent")
def q_track_extent(spark, sf_dir):
    return trk.track_extent(_retained_ticks(spark, sf_dir))


@register("track_legend")
def q_track_legend(spark, sf_dir):
    return trk.track_legend(_retained_ticks(spark, sf_dir))


@register("history_path")
def q_history_path(spark, sf_dir):
    return trk.history_path(fx.irregular(spark, sf_dir))


@register("track_geojson")
def q_track_geojson(spark, sf_dir):
    g = trk.track_geojson(_ticks_tracks(spark, sf_dir))
    p = g.select("sat_id", "satname",
                 F.from_json("track", "struct<geometry: struct<coordinates: array<array<double>>>>")
                 ["geometry"]["coordinates"].alias("c"),
                 F.from_json("head", "struct<geometry: struct<coordinates: array<double>>>")
                 ["geometry"]["coordinates"].alias("h"))
    return p.select(
        "sat_id", "satname", F.size("c").cast("bigint").alias("n_coords"),
        F.element_at("c", 1)[0].alias("first_lon"), F.element_at("c", 1)[1].alias("first_lat"),
        F.col("h")[0].alias("head_lon"), F.col("h")[1].alias("head_lat"))


@register("track_lines")
def q_track_lines(spark, sf_dir):
    """Tracks cut at the antimeridian, read back from their GeoJSON."""
    t = trk.track_lines(_ticks_tracks(spark, sf_dir))
    t = t.withColumn("c", F.from_json("track", "struct<geometry: struct<coordinates: array<array<array<double>>>>>")["geometry"]["coordinates"])
    points = F.flatten("c")
    # the first point of each line but the first lies on the cut
    cuts = F.transform(F.slice("c", 2, F.size("c")), lambda x: F.element_at(F.element_at(x, 1), 2))
    return t.select("sat_id", "satname", "popup", F.size("c").cast("bigint").alias("n_lines"), F.size(points).cast("bigint").alias("n_coords"),
                    F.round(F.aggregate(cuts, F.lit(0.0), lambda a, x: a + x), 5).alias("cut_latitude"),
                    F.size(F.filter(points, lambda p: F.abs(p[0]) == 180)).cast("bigint").alias("n_at_side"))


@register("map_features")
def q_map_features(spark, sf_dir):
    f = fx.ticks(spark, sf_dir)
    m = trk.map_features(_ticks_tracks(spark, sf_dir), _retained_ticks(spark, sf_dir), windows.data_now(f))
    at = F.when(F.col("kind") != "path", F.from_json("geometry", "struct<coordinates: array<double>>")["coordinates"])
    return m.select("kind", "sat_id", "popup", at[0].alias("lon"), at[1].alias("lat"), "title", "updated")


@register("track_labels")
def q_track_labels(spark, sf_dir):
    return trk.track_labels(_ticks_tracks(spark, sf_dir), _retained_ticks(spark, sf_dir))


@register("allowlist")
def q_allowlist(spark, sf_dir):
    """A mixed feed - the five tracked objects and seven untracked ones -
    through the tracked-object allow-list."""
    feed = fx.ticks(spark, sf_dir).unionByName(fx.ticks_n(spark, sf_dir, 7))
    return trk.allowlist(feed).select("sat_id", "seq", "timestamp")


# --- ingest, routing, codecs ------------------------------------------------

@register("topic_filter")
def q_topic_filter(spark, sf_dir):
    raw = fx.raw_positions(spark, sf_dir).unionByName(fx.raw_requests(spark, sf_dir))
    return ingest.topic_filter(raw).select("topic", "offset")


@register("parse_positions")
def q_parse_positions(spark, sf_dir):
    return ingest.parse_positions(fx.raw_positions(spark, sf_dir))


@register("parse_requests")
def q_parse_requests(spark, sf_dir):
    return ingest.parse_requests(fx.raw_requests(spark, sf_dir))


@register("validate_requests")
def q_validate_requests(spark, sf_dir):
    v = ingest.validate_requests(ingest.parse_requests(fx.raw_requests(spark, sf_dir)))
    return v.select("request_id", "choice_id", "obs_latitude", "obs_longitude", "reject_reason")


@register("route_requests")
def q_route_requests(spark, sf_dir):
    r = ingest.route_requests(ingest.parse_requests(fx.raw_requests(spark, sf_dir)))
    return r.select("request_id", "choice_id", "action")


@register("route_counts")
def q_route_counts(spark, sf_dir):
    return ingest.route_counts(ingest.parse_requests(fx.raw_requests(spark, sf_dir)))


@register("normalize_api")
def q_normalize_api(spark, sf_dir):
    docs = fx.api_documents(spark, sf_dir)
    return ingest.normalize_api(docs.select("sat_id", "value"))


@register("encode_positions")
def q_encode_positions(spark, sf_dir):
    m = codecs.encode_positions(fx.ticks(spark, sf_dir))
    d = m.select("topic", F.from_json("value", POSITION).alias("d"))   # parse once, then expand
    return d.select("topic", "d.*")


@register("encode_requests")
def q_encode_requests(spark, sf_dir):
    m = codecs.encode_requests(fx.requests(spark, sf_dir))
    d = m.select("topic", F.col("key").cast("bigint").alias("request_id"),
                 F.size(F.json_object_keys("value")).cast("bigint").alias("n_keys"),
                 F.from_json("value", REQUEST).alias("d"))
    return d.select("topic", "request_id", "n_keys", "d.*")


def _closest_msgs(spark, sf_dir):
    return codecs.closest_response(
        asof.closest_satellite(_choice(spark, sf_dir, 3), fx.irregular(spark, sf_dir)))


@register("closest_response")
def q_closest_response(spark, sf_dir):
    d = _closest_msgs(spark, sf_dir).select(
        "topic", F.col("key").cast("bigint").alias("request_id"),
        F.from_json("value", CLOSEST_RESPONSE).alias("d"))
    return d.select("topic", "request_id", "d.*")


@register("decode_responses")
def q_decode_responses(spark, sf_dir):
    d = codecs.decode_responses(_closest_msgs(spark, sf_dir))
    return d.withColumn("key", F.col("key").cast("bigint")).withColumnRenamed("key", "request_id")


@register("overlap_response")
def q_overlap_response(spark, sf_dir):
    m = codecs.overlap_response(overlap.coverage_overlap(fx.ticks(spark, sf_dir)))
    items = F.from_json("value", f"array<{OVERLAP_ITEM.simpleString()}>")
    return m.select("n_parts", F.explode(items).alias("i")).select("n_parts", "i.*")


@register("motion_response")
def q_motion_response(spark, sf_dir):
    top = q_motion_top5(spark, sf_dir)
    m = codecs.motion_response(top)
    x = m.select("batch", F.posexplode(F.from_json("value", MOTION_RESPONSE)).alias("item_index", "i"))
    return x.select("batch", F.col("item_index").cast("bigint").alias("item_index"),
                    "i.sat_id", "i.satname", "i.velocity_kmph",
                    F.col("i.direction.delta_latitude").alias("delta_latitude"),
                    F.col("i.direction.delta_longitude").alias("delta_longitude"), "i.timestamp")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Batch queries and streaming queries (all with a SQL oracle)."""
    return {**QUERIES, **STREAM_QUERIES}
