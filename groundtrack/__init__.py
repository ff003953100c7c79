"""groundtrack: positions of moving objects as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own expressions, so Catalyst prunes, pushes down and plans the shuffles.
The same operators serve batch tables and Structured Streaming input where
Spark allows it (see ``groundtrack.streaming``).

The main operators are importable from here::

    from groundtrack import coverage_overlap, closest_satellite, motion_vectors
"""

from groundtrack.functions.geo import haversine_km
from groundtrack.operators.asof import (
    asof_join,
    asof_positions,
    closest_satellite,
    motion_answers,
    overlap_answers,
    satellites_in_view,
)
from groundtrack.operators.codecs import (
    closest_response,
    decode_responses,
    encode_positions,
    encode_requests,
    motion_response,
    overlap_response,
)
from groundtrack.operators.ingest import (
    normalize_api,
    parse_positions,
    parse_requests,
    route_counts,
    route_requests,
    split,
    topic_filter,
    validate_requests,
)
from groundtrack.operators.latest import latest_positions, snapshot
from groundtrack.operators.motion import motion_top, motion_vectors
from groundtrack.operators.overlap import coverage_overlap
from groundtrack.operators.tracks import (
    allowlist,
    history_path,
    track_extent,
    track_geojson,
    track_heads,
    track_labels,
    track_legend,
    tracks,
)
from groundtrack.operators.windows import data_now, sliding_positions, track_retention
from groundtrack.params import (
    COVERAGE_RADIUS_KM,
    EARTH_RADIUS_KM,
    HISTORY_SAT_ID,
    LOOKBACK_S,
    OBSERVER,
    SAT_IDS,
)

__all__ = [
    "COVERAGE_RADIUS_KM", "EARTH_RADIUS_KM", "HISTORY_SAT_ID", "LOOKBACK_S", "OBSERVER", "SAT_IDS",
    "allowlist", "asof_join", "asof_positions", "closest_response", "closest_satellite",
    "coverage_overlap", "data_now", "decode_responses", "encode_positions", "encode_requests",
    "haversine_km", "history_path", "latest_positions", "motion_answers", "motion_response",
    "motion_top", "motion_vectors", "normalize_api", "overlap_answers", "overlap_response",
    "parse_positions", "parse_requests", "route_counts", "route_requests", "satellites_in_view",
    "sliding_positions", "snapshot", "split", "topic_filter", "track_extent", "track_geojson",
    "track_heads", "track_labels", "track_legend", "track_retention", "tracks",
    "validate_requests",
]
