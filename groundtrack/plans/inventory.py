"""
implemented and which registered keys exercise it. ``tests/test_inventory``
imports every function named here and checks every key is registered.

Entries with no key are built-in Spark facilities used through a helper
(sinks) or not built (the interactive / drawing parts, see README).
"""

from __future__ import annotations

OP = "groundtrack.operators"
ST = "groundtrack.streaming"

INVENTORY: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    # id: (what, implementing functions, registered keys)
    "S1": ("stream scan of all position topics", (f"{ST}.sources.read_positions", f"{ST}.sources.read_files", f"{ST}.records.read_log"),
           ("scan_positions", "scan_log")),
    "S2": ("stream scan of the request topic", (f"{ST}.sources.read_requests",), ("scan_requests",)),
    "S3": ("topic regex filter", (f"{OP}.ingest.topic_filter",), ("topic_filter",)),
    "S4": ("history scan of one object, ordered", (f"{OP}.tracks.history_path", f"{ST}.sinks.read_history_range",
                                                   "groundtrack.sources.tables.jdbc_table"), ("history_path",)),
    "S5": ("API document -> position row", (f"{OP}.ingest.normalize_api",), ("normalize_api",)),
    "K1": ("positions -> topic per object", (f"{OP}.codecs.encode_positions", f"{ST}.records.register"), ("encode_positions", "scan_log")),
    "K2": ("append to the history table", (f"{ST}.sinks.history_append", f"{ST}.sinks.compact_history"),
           ("history_append",)),
    "K3": ("overlap response lists", (f"{OP}.codecs.overlap_response",), ("overlap_response",)),
    "K4": ("closest response objects", (f"{OP}.codecs.closest_response",), ("closest_response", "closest_stream")),
    "K5": ("motion response lists", (f"{OP}.codecs.motion_response", f"{OP}.codecs.motion_request_response"),
           ("motion_response",)),
    "K6": ("request encoder", (f"{OP}.codecs.encode_requests",), ("encode_requests",)),
    "K7": ("response decoder", (f"{OP}.codecs.decode_responses",), ("decode_responses",)),
    "K8": ("console / memory sink", (f"{ST}.sinks.start",), ()),
    "K9": ("per-batch callback sink", (f"{ST}.sinks.start", f"{ST}.jobs.start_requests"), ("closest_stream",)),
    "K10": ("durable offsets (checkpoint)", (f"{ST}.sinks.start", "groundtrack.session.checkpoint_path"),
            ("motion_stream",)),
    "K11": ("track map output", (f"{OP}.tracks.track_geojson", f"{OP}.tracks.track_labels", f"{OP}.tracks.track_lines",
                               f"{OP}.tracks.simplify", f"{OP}.tracks.map_features"),
            ("track_geojson", "track_labels", "track_lines", "map_features")),
    "P1": ("bytes -> string", (f"{OP}.ingest.parse_positions",), ("parse_positions",)),
    "P2": ("parse JSON with a fixed schema", (f"{OP}.ingest.parse_positions", f"{OP}.ingest.parse_requests"),
           ("parse_positions", "parse_requests")),
    "P3": ("keep topic with the row", (f"{OP}.ingest.parse_positions",), ("parse_positions",)),
    "P4": ("arrival time", (f"{OP}.windows.with_arrival_time", f"{OP}.windows.with_event_time"), ()),
    "P5": ("choice -> action", (f"{OP}.ingest.route_requests",), ("route_requests",)),
    "P6": ("route filter and counts", (f"{OP}.ingest.route_counts",), ("route_counts",)),
    "P7": ("closest-request filter", (f"{ST}.state.answer_requests",), ("closest_satellite",)),
    "P8": ("request validation", (f"{OP}.ingest.validate_requests",), ("validate_requests",)),
    "P9": ("object allow-list", (f"{OP}.tracks.allowlist",), ("allowlist",)),
    "P10": ("single-object predicate", (f"{OP}.tracks.history_path",), ("history_path", "history_append")),
    "P11": ("projection before pairing", (f"{OP}.overlap.coverage_overlap",), ("coverage_overlap",)),
    "P12": ("pair projection and renames", (f"{OP}.overlap.pairs",), ("coverage_overlap",)),
    "P13": ("struct field access", (f"{OP}.windows.sliding_positions",), ("sliding_positions",)),
    "P14": ("overlap flag and depth", (f"{OP}.overlap.pairs",), ("coverage_overlap",)),
    "P15": ("display snapshot", (f"{OP}.latest.snapshot",), ("snapshot",)),
    "P16": ("record pretty-print", (f"{OP}.latest.snapshot",), ("snapshot",)),
    "J1": ("coverage overlap self-join", (f"{OP}.overlap.coverage_overlap", f"{OP}.interpolate.overlap_within"),
           ("coverage_overlap", "coverage_overlap_gated", "coverage_overlap_hits", "coverage_overlap_within")),
    "J2": ("closest object per request", (f"{OP}.asof.closest_satellite",),
           ("closest_satellite", "closest_satellite_grid", "closest_many")),
    "J3": ("as-of latest fix", (f"{OP}.asof.asof_join", f"{OP}.asof.asof_positions", f"{ST}.live.asof_live"), ("asof_positions", "asof_live")),
    "A1": ("latest fix per object", (f"{OP}.latest.latest_positions",), ("latest_positions", "snapshot_stream")),
    "A2": ("arg-min of distance", (f"{OP}.asof.closest_satellite",), ("closest_satellite",)),
    "A3": ("last position per window", (f"{OP}.windows.sliding_positions",), ("sliding_positions",)),
    "A4": ("object-count gate", (f"{OP}.asof.satellites_in_view", f"{OP}.overlap.complete_instants"),
           ("snapshot_complete", "coverage_overlap_gated")),
    "A5": ("at least two points", (f"{OP}.motion.motion_vectors", f"{OP}.tracks.tracks"), ("motion_vectors", "tracks")),
    "A6": ("ordered path per object", (f"{OP}.tracks.tracks", f"{OP}.tracks.track_points"), ("tracks",)),
    "A7": ("global extent", (f"{OP}.tracks.track_extent",), ("track_extent",)),
    "A8": ("legend", (f"{OP}.tracks.track_legend",), ("track_legend",)),
    "W1": ("sliding window 30 min / 2 min", (f"{OP}.windows.sliding_positions", f"{ST}.keyed.sliding_panes"),
           ("sliding_positions", "sliding_stream", "sliding_panes")),
    "W2": ("watermark", (f"{OP}.windows.sliding_positions",), ("sliding_stream",)),
    "W3": ("motion vector", (f"{OP}.motion.motion_vectors", f"{ST}.keyed.motion_stream"),
           ("motion_vectors", "motion_vectors_irregular", "motion_stream")),
    "L1": ("order history by time", (f"{OP}.tracks.history_path",), ("history_path",)),
    "L2": ("first five vectors of a batch", (f"{OP}.motion.motion_top",), ("motion_top5",)),
    "L3": ("last point of each track", (f"{OP}.tracks.track_heads",), ("track_heads",)),
    "F1": ("haversine (difference of radians)", ("groundtrack.functions.geo.haversine_km",), ("haversine_pairs",)),
    "F2": ("haversine (radians of difference)", ("groundtrack.functions.geo.haversine_km",), ("closest_satellite",)),
    "F3": ("radians, trigonometry, square root", ("groundtrack.functions.geo.geo_parts",), ("coverage_overlap",)),
    "F4": ("rounding 2 / 4 / 5 dp", (f"{OP}.latest.snapshot", f"{OP}.motion.vector_columns"), ("snapshot",)),
    "F5": ("string building", (f"{OP}.codecs.encode_positions", f"{OP}.tracks.track_labels"), ("track_labels",)),
    "F6": ("time formatting", (f"{OP}.tracks.hhmm",), ("track_labels",)),
    "F7": ("now", (f"{OP}.codecs.encode_requests", f"{OP}.windows.data_now"), ("track_retention",)),
    "F8": ("JSON encode / decode", (f"{OP}.codecs.decode_responses",), ("decode_responses",)),
    "F9": ("nested get with default", (f"{OP}.ingest.normalize_api",), ("normalize_api",)),
    "F10": ("cast, when, literals", (f"{OP}.ingest.route_requests",), ("route_requests",)),
    "F11": ("time difference", (f"{OP}.windows.track_retention",), ("track_retention",)),
    "T1": ("output modes", (f"{ST}.sinks.start",), ("sliding_stream", "snapshot_stream")),
    "T2": ("keyed state: latest position", (f"{ST}.state.latest_snapshot", f"{ST}.snapshots.write_delta", f"{ST}.snapshots.read_latest"),
           ("snapshot_stream", "snapshot_deltas")),
    "T3": ("keyed state: trailing history", (f"{ST}.keyed.motion_stream",), ("motion_stream", "motion_stream_late")),
    "T4": ("state shared between queries", (f"{ST}.state.answer_requests", f"{ST}.jobs.start_requests", f"{ST}.jobs.start_live",
                                               f"{ST}.rollup.cache", f"{ST}.rollup.vectors"),
           ("closest_stream", "closest_live", "motion_answers_stream")),
    "T5": ("track retention", (f"{OP}.windows.track_retention",), ("track_retention",)),
    "T6": ("throttle", (f"{ST}.sinks.start", f"{ST}.supervise.observed"), ("supervised_counts",)),
    "T7": ("run until stopped", ("groundtrack.__main__.main", f"{ST}.supervise.keep_running"), ("supervised_counts",)),
    "T8": ("stream vs batch tracks", (f"{OP}.tracks.tracks",), ("stream_batch_parity",)),
}
