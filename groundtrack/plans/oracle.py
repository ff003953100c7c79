"""Equivalent SQL (DuckDB dialect) for the registered queries.

The views ``ticks``, ``irregular``, ``ticks_n`` and ``requests`` are written
here again as SQL over ``events`` so the oracle shares no code path with the
Spark plans. Column names and types match ``queries.py``.
"""

from __future__ import annotations

from groundtrack.params import OBSERVER, SAT_IDS

_IDS = "[" + ", ".join(f"'{s}'" for s in SAT_IDS) + "]"
D = "CAST({} AS DOUBLE)".format


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in km on a sphere of 6371 km."""
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    a = (f"(sin(({p2} - {p1}) / 2) * sin(({p2} - {p1}) / 2) + cos({p1}) * cos({p2}) * "
         f"sin((radians({lon2}) - radians({lon1})) / 2) * sin((radians({lon2}) - radians({lon1})) / 2))")
    return f"(12742.0 * atan2(sqrt({a}), sqrt(greatest(1.0 - {a}, 0.0))))"


def _pos(k: str, tick: str, ts: str, sat_id: str) -> str:
    return f"""SELECT {sat_id} AS sat_id, 'Sat ' || {sat_id} AS satname,
      CAST((({tick}) * 37 + ({k}) * 2900) % 16000 AS DOUBLE) / 100 - 80 AS latitude,
      CAST((({tick}) * 61 + ({k}) * 7100) % 36000 AS DOUBLE) / 100 - 180 AS longitude,
      CAST((event_id * 7919) % 3600000 AS DOUBLE) / 9973 AS azimuth,
      CAST((event_id * 104729) % 900000 AS DOUBLE) / 9973 AS elevation,
      CAST({ts} AS BIGINT) AS timestamp, event_id AS seq FROM events"""


TICKS = "ticks AS (" + _pos("event_id % 5", "event_id // 5", "1745211600 + 18 * (event_id // 5)",
                            f"{_IDS}[(event_id % 5) + 1]") + ")"
IRREGULAR = "irregular AS (" + _pos("user_id % 5", "event_id", "epoch_us(ts) // 1000000",
                                    f"{_IDS}[(user_id % 5) + 1]") + ")"


def ticks_n(n: int, name: str | None = None) -> str:
    return f"{name or f'ticks_{n}'} AS (" + _pos(
        f"event_id % {n}", f"event_id // {n}", f"1745211600 + 18 * (event_id // {n})",
        f"CAST(event_id % {n} AS VARCHAR)") + ")"


REQUESTS = """requests AS (SELECT event_id AS request_id,
      CAST((event_id * 53) % 18000 AS DOUBLE) / 100 - 90 AS obs_latitude,
      CAST((event_id * 97) % 36000 AS DOUBLE) / 100 - 180 AS obs_longitude,
      value AS altitude, epoch_us(ts) // 1000000 AS timestamp,
      CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
           WHEN 'signup' THEN 4 WHEN 'error' THEN 9 END AS INTEGER) AS choice_id
    FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def overlap_sql(src: str) -> str:
    d = haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    return f"""SELECT timestamp, round(d, 2) AS distance_km, d < 5000.0 AS overlap,
      round(CASE WHEN d < 5000.0 THEN CAST(5000 AS DOUBLE) - d ELSE CAST(0 AS DOUBLE) END, 2) AS overlap_km,
      satname1, satname2, sat_id1, sat_id2, lat1, lon1, lat2, lon2
    FROM (SELECT a.timestamp, a.satname AS satname1, b.satname AS satname2,
                 a.sat_id AS sat_id1, b.sat_id AS sat_id2,
                 a.latitude AS lat1, a.longitude AS lon1, b.latitude AS lat2, b.longitude AS lon2,
                 {d} AS d
          FROM {src} a JOIN {src} b ON a.timestamp = b.timestamp AND a.sat_id < b.sat_id) p"""


def asof_sql(choice: int, lookback: int | None = None) -> str:
    since = f"f.timestamp >= r.timestamp - {lookback} AND " if lookback else ""
    return f"""asof_rows AS (SELECT request_id, request_ts, obs_latitude, obs_longitude, sat_id, satname,
           latitude, longitude, fix_ts, fix_seq FROM (
      SELECT r.request_id, r.timestamp AS request_ts, r.obs_latitude, r.obs_longitude,
             f.sat_id, f.satname, f.latitude, f.longitude, f.timestamp AS fix_ts, f.seq AS fix_seq,
             row_number() OVER (PARTITION BY r.request_id, f.sat_id
                                ORDER BY f.timestamp DESC, f.seq DESC) AS rn
      FROM requests r JOIN irregular f
        ON {since}f.timestamp <= r.timestamp
      WHERE r.choice_id = {choice}) x WHERE rn = 1)"""


def motion_sql(src: str, lookback: int = 300) -> str:
    d = haversine_sql("p.lat", "p.lon", "latitude", "longitude")
    return f"""mv AS (SELECT sat_id, satname, timestamp, seq, p.t AS prev_timestamp,
      round(CASE WHEN timestamp = p.t THEN CAST(0 AS DOUBLE)
                 ELSE {d} / (CAST(timestamp - p.t AS DOUBLE) / CAST(3600 AS DOUBLE)) END, 2) AS velocity_kmph,
      round(CASE WHEN timestamp = p.t THEN CAST(0 AS DOUBLE) ELSE latitude - p.lat END, 5) AS delta_latitude,
      round(CASE WHEN timestamp = p.t THEN CAST(0 AS DOUBLE) ELSE longitude - p.lon END, 5) AS delta_longitude
    FROM (SELECT *, min({{'t': timestamp, 's': seq, 'lat': latitude, 'lon': longitude}}) OVER (
            PARTITION BY sat_id ORDER BY timestamp RANGE BETWEEN {lookback} PRECEDING AND CURRENT ROW) AS p
          FROM {src}) w
    WHERE p.t < timestamp OR (p.t = timestamp AND p.s < seq))"""


def sliding_sql(src: str) -> str:
    return f"""win AS (SELECT ws AS window_start, ws + 1800 AS window_end, sat_id, satname,
        max({{'t': timestamp, 's': seq, 'lat': latitude, 'lon': longitude}}).lat AS latitude,
        max({{'t': timestamp, 's': seq, 'lat': latitude, 'lon': longitude}}).lon AS longitude,
        max(timestamp) AS timestamp
      FROM (SELECT f.*, f.timestamp - f.timestamp % 120 - 120 * i.i AS ws
            FROM {src} f, (SELECT range AS i FROM range(15)) i) x
      GROUP BY ws, sat_id, satname)"""


RETAINED_TICKS = sliding_sql("ticks") + """,
    kept AS (SELECT * FROM win WHERE (SELECT max(timestamp) FROM ticks) - window_end <= 1800),
    pts AS (SELECT *, row_number() OVER (PARTITION BY sat_id ORDER BY window_start) - 1 AS point_index,
                   count(*) OVER (PARTITION BY sat_id) AS n_points,
                   first_value(satname) OVER (PARTITION BY sat_id ORDER BY window_start) AS first_name
            FROM kept)"""

OBS_D = haversine_sql(str(OBSERVER[0]), str(OBSERVER[1]), "latitude", "longitude")

ORACLE: dict[str, str] = {
    "coverage_overlap": with_(TICKS) + overlap_sql("ticks"),
    "coverage_overlap_gated": with_(ticks_n(7, "t7"), """t7ok AS (SELECT * FROM t7 WHERE timestamp IN (
        SELECT timestamp FROM t7 GROUP BY timestamp HAVING count(DISTINCT sat_id) = 7))""")
        + overlap_sql("t7ok"),
    "coverage_overlap_hits": with_(ticks_n(50, "t50")) + "SELECT * FROM (" + overlap_sql("t50") + ") o WHERE overlap",
    "haversine_pairs": with_(TICKS) + f"SELECT sat_id, seq, timestamp, round({OBS_D}, 2) AS distance_km FROM ticks",
    "latest_positions": with_(IRREGULAR) + """SELECT sat_id, satname, latitude, longitude, azimuth,
        elevation, timestamp, seq FROM (SELECT *, row_number() OVER (PARTITION BY sat_id
        ORDER BY timestamp DESC, seq DESC) AS rn FROM irregular) x WHERE rn = 1""",
    "snapshot": with_(IRREGULAR) + """SELECT satname, sat_id, round(latitude, 4) AS latitude,
        round(longitude, 4) AS longitude, round(azimuth, 2) AS azimuth, round(elevation, 2) AS elevation,
        timestamp FROM (SELECT *, row_number() OVER (PARTITION BY sat_id
        ORDER BY timestamp DESC, seq DESC) AS rn FROM irregular) x WHERE rn = 1""",
    "asof_positions": with_(IRREGULAR, REQUESTS, asof_sql(3)) + "SELECT * FROM asof_rows",
    "asof_positions_1h": with_(IRREGULAR, REQUESTS, asof_sql(3, 3600)) + "SELECT * FROM asof_rows",
    "closest_satellite": with_(IRREGULAR, REQUESTS, asof_sql(3)) + f"""SELECT request_id, satname, sat_id,
        latitude, longitude, round(d, 2) AS distance_km, obs_latitude AS observer_lat,
        obs_longitude AS observer_lon, request_ts AS timestamp, fix_ts FROM (
          SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY d, sat_id) AS rk FROM (
            SELECT *, {haversine_sql('obs_latitude', 'obs_longitude', 'latitude', 'longitude')} AS d
            FROM asof_rows) y WHERE d IS NOT NULL) z WHERE rk = 1""",
    "snapshot_complete": with_(IRREGULAR, REQUESTS, asof_sql(2)) + """SELECT request_id,
        count(DISTINCT sat_id) AS n_satellites, count(DISTINCT sat_id) = 5 AS complete
        FROM asof_rows GROUP BY request_id""",
    "motion_vectors": with_(TICKS, motion_sql("ticks")) + "SELECT * FROM mv",
    "motion_vectors_irregular": with_(IRREGULAR, motion_sql("irregular")) + "SELECT * FROM mv",
    "motion_top5": with_(TICKS, motion_sql("ticks")) + """SELECT * FROM (SELECT *,
        timestamp // 90 AS batch,
        row_number() OVER (PARTITION BY timestamp // 90 ORDER BY timestamp, seq) AS rank FROM mv) x
        WHERE rank <= 5""",
    "sliding_positions": with_(IRREGULAR, sliding_sql("irregular")) + "SELECT * FROM win",
    "track_retention": with_(IRREGULAR, sliding_sql("irregular"))
        + "SELECT * FROM win WHERE (SELECT max(timestamp) FROM irregular) - window_end <= 1800",
    "tracks": with_(TICKS, RETAINED_TICKS) + """SELECT sat_id, first_name AS satname, point_index,
        window_start, window_end, timestamp, latitude, longitude FROM pts WHERE n_points >= 2""",
    "track_heads": with_(TICKS, RETAINED_TICKS) + """SELECT sat_id, first_name AS satname, window_start,
        window_end, timestamp, latitude, longitude FROM pts
        WHERE n_points >= 2 AND point_index = n_points - 1""",
    "track_extent": with_(TICKS, RETAINED_TICKS) + """SELECT min(window_start) AS oldest_window_start,
        max(window_end) AS latest_window_end, count(DISTINCT sat_id) AS n_satellites FROM kept""",
    "track_legend": with_(TICKS, RETAINED_TICKS) + """SELECT sat_id, first_name AS satname,
        count(*) AS n_windows FROM pts GROUP BY sat_id, first_name""",
    "history_path": with_(IRREGULAR) + """SELECT satname, latitude, longitude, timestamp, seq
        FROM irregular WHERE sat_id = '49810' ORDER BY timestamp, seq""",
    "track_geojson": with_(TICKS, RETAINED_TICKS) + """SELECT sat_id, first_name AS satname,
        n_points AS n_coords,
        max(CASE WHEN point_index = 0 THEN longitude END) AS first_lon,
        max(CASE WHEN point_index = 0 THEN latitude END) AS first_lat,
        max(CASE WHEN point_index = n_points - 1 THEN longitude END) AS head_lon,
        max(CASE WHEN point_index = n_points - 1 THEN latitude END) AS head_lat
        FROM pts WHERE n_points >= 2 GROUP BY sat_id, first_name, n_points""",
    "allowlist": with_(TICKS, ticks_n(7, "t7")) + """SELECT sat_id, seq, timestamp FROM (
        SELECT sat_id, seq, timestamp FROM ticks UNION ALL SELECT sat_id, seq, timestamp FROM t7) f
        WHERE sat_id IN ('49810', '43566', '43056', '41550', '41174')""",
}


_TEV = with_(TICKS) + "SELECT t.*, e.event_type FROM ticks t JOIN events e ON e.event_id = t.seq"
_RAWREQ = with_(REQUESTS) + """SELECT request_id, obs_latitude, obs_longitude, altitude, timestamp,
        CASE WHEN choice_id = 9 THEN NULL ELSE choice_id END AS choice_id FROM requests"""
_ACTION = """CASE choice_id WHEN 1 THEN 'motion_vector' WHEN 2 THEN 'overlap' WHEN 3 THEN 'closest'
        WHEN 4 THEN 'exit' ELSE 'unknown' END"""
_CLOSEST = ORACLE["closest_satellite"]
ORACLE["closest_satellite_grid"] = _CLOSEST
ORACLE["closest_satellite_1h"] = _CLOSEST.replace("ON f.timestamp <=", "ON f.timestamp >= r.timestamp - 3600 AND f.timestamp <=")

_HHMM = "printf('%02d:%02d', CAST(({0}) % 86400 // 3600 AS INTEGER), CAST(({0}) % 3600 // 60 AS INTEGER))".format

ORACLE.update({
    "motion_answers": with_(IRREGULAR, REQUESTS, motion_sql("irregular")) + """SELECT request_id, timestamp,
        sat_id, satname, velocity_kmph, delta_latitude, delta_longitude, vector_ts FROM (
          SELECT r.request_id, r.timestamp, v.sat_id, v.satname, v.velocity_kmph, v.delta_latitude,
                 v.delta_longitude, v.timestamp AS vector_ts,
                 row_number() OVER (PARTITION BY r.request_id, v.sat_id ORDER BY v.timestamp DESC, v.seq DESC) AS rn
          FROM requests r JOIN mv v ON v.timestamp <= r.timestamp
          WHERE r.choice_id = 1) x WHERE rn = 1""",
    "overlap_answers": with_(IRREGULAR, REQUESTS, asof_sql(2)) + """SELECT request_id, timestamp,
        round(d, 2) AS distance_km, d < 5000.0 AS overlap,
        round(CASE WHEN d < 5000.0 THEN CAST(5000 AS DOUBLE) - d ELSE CAST(0 AS DOUBLE) END, 2) AS overlap_km,
        sat_id1, sat_id2, satname1, satname2, lat1, lon1, lat2, lon2 FROM (
          SELECT x.request_id, x.fix_ts AS timestamp, x.sat_id AS sat_id1, y.sat_id AS sat_id2,
                 x.satname AS satname1, y.satname AS satname2, x.latitude AS lat1, x.longitude AS lon1,
                 y.latitude AS lat2, y.longitude AS lon2, """
        + haversine_sql("x.latitude", "x.longitude", "y.latitude", "y.longitude") + """ AS d
          FROM asof_rows x JOIN asof_rows y ON x.request_id = y.request_id AND x.fix_ts = y.fix_ts
            AND x.sat_id < y.sat_id) p""",
    "track_labels": with_(TICKS, RETAINED_TICKS) + f"""SELECT sat_id,
        first_name || ' (ID: ' || sat_id || ')' AS popup,
        {_HHMM('window_start')} || ' to ' || {_HHMM('window_end')} AS window_label,
        'Satellite Tracking - ' || {_HHMM('(SELECT min(window_start) FROM kept)')} || ' to '
          || {_HHMM('(SELECT max(window_end) FROM kept)')} AS title
        FROM pts WHERE n_points >= 2 AND point_index = n_points - 1""",
    "topic_filter": with_(TICKS) + "SELECT 'satellite-' || sat_id AS topic, seq AS offset FROM ticks",
    "parse_positions": f"""SELECT 'satellite-' || sat_id AS topic, seq,
        CASE WHEN err THEN NULL ELSE sat_id END AS sat_id, CASE WHEN err THEN NULL ELSE satname END AS satname,
        CASE WHEN err THEN NULL ELSE latitude END AS latitude,
        CASE WHEN err THEN NULL ELSE longitude END AS longitude,
        CASE WHEN err THEN NULL ELSE azimuth END AS azimuth,
        CASE WHEN err THEN NULL ELSE elevation END AS elevation,
        CASE WHEN err THEN NULL ELSE timestamp END AS timestamp,
        CASE WHEN err THEN 'unparseable' END AS reject_reason
      FROM (SELECT *, event_type = 'error' AS err FROM ({_TEV}) x) y""",
    "parse_requests": _RAWREQ,
    "validate_requests": f"""SELECT request_id, choice_id, obs_latitude, obs_longitude,
        CASE WHEN choice_id IS NULL THEN 'missing_choice' WHEN choice_id NOT IN (1, 2, 3) THEN 'invalid_choice'
             WHEN choice_id = 3 AND (obs_latitude IS NULL OR obs_longitude IS NULL) THEN 'missing_location'
             WHEN timestamp IS NULL THEN 'missing_timestamp'
        END AS reject_reason FROM ({_RAWREQ}) r""",
    "route_requests": f"SELECT request_id, choice_id, {_ACTION} AS action FROM ({_RAWREQ}) r",
    "route_counts": f"""SELECT {_ACTION} AS action, count(*) AS n_requests FROM ({_RAWREQ}) r
        GROUP BY 1""",
    "normalize_api": f"""SELECT sat_id,
        CASE WHEN event_type = 'signup' THEN 'Unknown' ELSE satname END AS satname,
        CASE WHEN err THEN NULL ELSE latitude END AS latitude,
        CASE WHEN err THEN NULL ELSE longitude END AS longitude,
        CASE WHEN err THEN NULL ELSE azimuth END AS azimuth,
        CASE WHEN err THEN NULL ELSE elevation END AS elevation,
        CASE WHEN err THEN NULL ELSE timestamp END AS timestamp,
        CASE WHEN err THEN 'no_positions' END AS reject_reason
      FROM (SELECT *, event_type = 'error' AS err FROM ({_TEV}) x) y""",
    "encode_positions": with_(TICKS) + """SELECT 'satellite-' || sat_id AS topic, sat_id, satname,
        latitude, longitude, azimuth, elevation, timestamp FROM ticks""",
    "encode_requests": with_(REQUESTS) + """SELECT 'observer_location' AS topic, request_id,
        CAST(7 AS BIGINT) AS n_keys, obs_latitude, obs_longitude, altitude, timestamp, choice_id FROM requests""",
    "closest_response": f"""SELECT 'observer_response' AS topic, request_id, satname, sat_id, latitude,
        longitude, distance_km, observer_lat, observer_lon, timestamp FROM ({_CLOSEST}) c""",
    "decode_responses": f"""SELECT 'observer_response' AS topic, request_id, CAST(0 AS BIGINT) AS part,
        CAST(1 AS BIGINT) AS n_parts, satname, sat_id, latitude, longitude, distance_km, observer_lat, observer_lon,
        timestamp, CAST(NULL AS VARCHAR) AS reject_reason FROM ({_CLOSEST}) c""",
    "overlap_response": f"""SELECT CAST(1 AS BIGINT) AS n_parts, timestamp, satname1, satname2, distance_km,
        overlap, overlap_km, lat1, lon1, lat2, lon2 FROM ({ORACLE['coverage_overlap']}) o""",
    "motion_response": f"""SELECT batch, rank - 1 AS item_index, sat_id, satname, velocity_kmph,
        delta_latitude, delta_longitude, timestamp FROM ({ORACLE['motion_top5']}) m""",
})


# Stream keys: the streamed result equals the batch result (ordered input,
# nothing late), so the batch SQL is their oracle as well.
ORACLE.update({
    "scan_positions": ORACLE["parse_positions"],
    "scan_requests": f"""SELECT CAST(request_id AS VARCHAR) AS request_id, obs_latitude, obs_longitude, altitude, timestamp, choice_id,
        CASE WHEN choice_id IS NULL THEN 'missing_choice' WHEN choice_id NOT IN (1, 2, 3) THEN 'invalid_choice'
             WHEN choice_id = 3 AND (obs_latitude IS NULL OR obs_longitude IS NULL) THEN 'missing_location'
             WHEN timestamp IS NULL THEN 'missing_timestamp'
        END AS reject_reason, {_ACTION} AS action FROM ({_RAWREQ}) r""",
    "history_append": with_(TICKS) + """SELECT satname, latitude, longitude, timestamp, seq
        FROM ticks WHERE sat_id = '49810'""",
    "motion_stream": with_(TICKS, motion_sql("ticks")) + "SELECT * FROM mv",
    "snapshot_stream": ORACLE["latest_positions"],
    "closest_stream": f"""SELECT 'observer_response' AS topic, CAST(request_id AS VARCHAR) AS key, CAST(0 AS BIGINT) AS part,
        CAST(1 AS BIGINT) AS n_parts, satname, sat_id, latitude, longitude, distance_km, observer_lat, observer_lon,
        timestamp, CAST(NULL AS VARCHAR) AS reject_reason FROM ({_CLOSEST}) c""",
    "motion_stream_late": with_(TICKS, motion_sql("ticks")) + "SELECT * FROM mv",
    # every object is polled each 18 s, so its last fix is at most that old
    "answers_whole": with_(ticks_n(60, "t60"), """seen AS (SELECT * FROM (
        SELECT f.*, r.timestamp AS ask, row_number() OVER (PARTITION BY r.timestamp, sat_id ORDER BY f.timestamp DESC) AS rn
        FROM (SELECT DISTINCT timestamp FROM t60) r JOIN t60 f ON f.timestamp IN (r.timestamp, r.timestamp - 18)) x WHERE rn = 1)""") + """SELECT 'r' || timestamp AS key, CAST(ceil(count(*) / 50) AS BIGINT) AS n_parts,
        CAST(ceil(count(*) / 50) AS BIGINT) AS parts_seen, count(*) AS n_pairs, count(*) FILTER (overlap) AS n_overlap,
        max(distance_km) AS farthest_km, CAST(0 AS BIGINT) AS n_rejected FROM (
        SELECT r.timestamp, round(d, 2) AS distance_km, d < 5000.0 AS overlap FROM (
          SELECT a.ask AS timestamp, """ + haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude") + """ AS d
          FROM seen a JOIN seen b ON a.ask = b.ask AND a.timestamp = b.timestamp AND a.sat_id < b.sat_id) r) o GROUP BY timestamp""",
    "closest_mixed_ids": with_(IRREGULAR, REQUESTS) + f"""SELECT 'observer_location:' || (request_id % 2) || ':' || (request_id // 2) AS key,
        ids AS sat_id, round(d, 2) AS distance_km, request_ts AS timestamp FROM (
          SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY d, ids) AS rk FROM (
            SELECT r.request_id, r.timestamp AS request_ts, f.ids, {haversine_sql('r.obs_latitude', 'r.obs_longitude', 'f.latitude', 'f.longitude')} AS d,
                   row_number() OVER (PARTITION BY r.request_id, f.ids ORDER BY f.timestamp DESC, f.seq DESC) AS rn
            FROM requests r JOIN (SELECT *, ['7', '007', '10', '9', 'A1'][list_position({_IDS}, sat_id)] AS ids FROM irregular) f ON f.timestamp <= r.timestamp
            WHERE r.choice_id = 3) x WHERE rn = 1) z WHERE rk = 1""",
    "sliding_stream": ORACLE["sliding_positions"],
    "stream_batch_parity": with_(TICKS, RETAINED_TICKS) + """SELECT DISTINCT sat_id, n_points AS batch_points,
        n_points AS stream_points, true AS same_path FROM pts WHERE n_points >= 2""",
})


# The streams joined, the slots, the deltas, the roll-ups: the batch rows again.
ORACLE.update({
    "asof_live": ORACLE["asof_positions_1h"].replace("SELECT * FROM asof_rows", "SELECT * REPLACE (CAST(request_id AS VARCHAR) AS request_id) FROM asof_rows"),
    "closest_live": f"SELECT * REPLACE (CAST(request_id AS VARCHAR) AS request_id) FROM ({ORACLE['closest_satellite_1h']}) c",
    "sliding_panes": ORACLE["sliding_positions"],
    "snapshot_deltas": ORACLE["latest_positions"],
    "motion_answers_stream": f"""SELECT CAST(request_id AS VARCHAR) AS request_id, sat_id, satname, velocity_kmph, delta_latitude,
        delta_longitude, vector_ts, CAST(NULL AS VARCHAR) AS reject_reason FROM ({ORACLE['motion_answers']}) m""",
    "scan_log": f"SELECT * EXCLUDE (seq) FROM ({ORACLE['parse_positions']}) p",
    "supervised_counts": """SELECT 'archive' AS query, count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_rejected,
        CAST(NULL AS BIGINT) AS n_answerable, CAST(0 AS BIGINT) AS n_late, CAST(0 AS BIGINT) AS n_failures FROM events
      UNION ALL SELECT 'requests', count(*), count(*) FILTER (event_type IN ('error', 'signup')), count(*) FILTER (event_type NOT IN ('error', 'signup')),
        0, 0 FROM events""",
    # every object at the multiples of ten minutes, on the great circle between
    # its fixes at most an hour apart
    "coverage_overlap_within": with_(IRREGULAR, """one AS (SELECT sat_id, timestamp, arg_max(satname, seq) AS satname, arg_max(latitude, seq) AS latitude,
        arg_max(longitude, seq) AS longitude FROM irregular GROUP BY sat_id, timestamp)""",
        """u AS (SELECT *, cos(radians(latitude)) * cos(radians(longitude)) AS x, cos(radians(latitude)) * sin(radians(longitude)) AS y,
        sin(radians(latitude)) AS z FROM one)""",
        """nxt AS (SELECT *, lead(timestamp) OVER w AS t1, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(z) OVER w AS z1
        FROM u WINDOW w AS (PARTITION BY sat_id ORDER BY timestamp))""",
        """grid AS (SELECT *, 2 * asin(least(sqrt((x1 - x) * (x1 - x) + (y1 - y) * (y1 - y) + (z1 - z) * (z1 - z)) / 2, 1.0)) AS w,
        unnest(generate_series(CAST(ceil(timestamp / 600) AS BIGINT) * 600, CASE WHEN t1 - timestamp <= 3600 THEN t1 - 1 ELSE timestamp END, 600)) AS t
        FROM nxt)""",
        """way AS (SELECT *, t = timestamp AS exact, CASE WHEN t > timestamp THEN CAST(t - timestamp AS DOUBLE) / CAST(t1 - timestamp AS DOUBLE) END AS f
        FROM grid WHERE t = timestamp OR w < pi() - 1e-6)""",
        """parts AS (SELECT *, CASE WHEN w < 1e-12 THEN 1 - f ELSE sin((1 - f) * w) / sin(w) END AS a, CASE WHEN w < 1e-12 THEN f ELSE sin(f * w) / sin(w) END AS b
        FROM way)""",
        """there AS (SELECT sat_id, satname, t AS timestamp,
        CASE WHEN exact THEN latitude ELSE degrees(atan2(a * z + b * z1, sqrt((a * x + b * x1) * (a * x + b * x1) + (a * y + b * y1) * (a * y + b * y1)))) END AS latitude,
        CASE WHEN exact THEN longitude ELSE degrees(atan2(a * y + b * y1, a * x + b * x1)) END AS longitude FROM parts)""")
        + "SELECT * REPLACE (round(lat1, 5) AS lat1, round(lon1, 5) AS lon1, round(lat2, 5) AS lat2, round(lon2, 5) AS lon2) FROM (" + overlap_sql("there") + ") o",
    "closest_many": with_(ticks_n(200, "t200"), REQUESTS, """asked AS (SELECT request_id, obs_latitude, obs_longitude,
        1745211600 + 18 * (request_id // 500) AS request_ts FROM requests)""") + f"""SELECT request_id, satname, sat_id, latitude, longitude,
        round(d, 2) AS distance_km, obs_latitude AS observer_lat, obs_longitude AS observer_lon, request_ts AS timestamp, fix_ts FROM (
          SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY d, sat_id) AS rk FROM (
            SELECT r.*, f.sat_id, f.satname, f.latitude, f.longitude, f.timestamp AS fix_ts,
                   {haversine_sql('r.obs_latitude', 'r.obs_longitude', 'f.latitude', 'f.longitude')} AS d
            FROM asked r JOIN (SELECT a.request_ts, f.*, row_number() OVER (PARTITION BY a.request_ts, f.sat_id ORDER BY f.timestamp DESC, f.seq DESC) AS rn
                               FROM (SELECT DISTINCT request_ts FROM asked) a JOIN t200 f ON f.timestamp <= a.request_ts) f
              ON f.request_ts = r.request_ts AND f.rn = 1) x) z WHERE rk = 1""",
    "track_lines": with_(TICKS, RETAINED_TICKS, """steps AS (SELECT *, lag(longitude) OVER w AS lon0, lag(latitude) OVER w AS lat0 FROM pts
        WHERE n_points >= 2 WINDOW w AS (PARTITION BY sat_id ORDER BY window_start))""",
        """cut AS (SELECT *, coalesce(abs(longitude - lon0) > 180, false) AS over, lat0 + (180 - abs(lon0)) / (360 - abs(longitude - lon0)) * (latitude - lat0) AS lat FROM steps)""")
        + """SELECT sat_id, first_name AS satname, first_name || ' Path' AS popup, CAST(1 + count(*) FILTER (over) AS BIGINT) AS n_lines,
        CAST(count(*) + 2 * count(*) FILTER (over) AS BIGINT) AS n_coords, round(coalesce(sum(lat) FILTER (over), 0.0), 5) AS cut_latitude,
        CAST(2 * count(*) FILTER (over) AS BIGINT) AS n_at_side FROM cut GROUP BY sat_id, first_name""",
    "map_features": with_(TICKS, RETAINED_TICKS, """ends AS (SELECT * FROM pts WHERE n_points >= 2 AND point_index = n_points - 1)""",
        f"""texts AS (SELECT 'Satellite Tracking - ' || {_HHMM('min(window_start)')} || ' to ' || {_HHMM('max(window_end)')} AS title,
        'Last updated: ' || strftime(make_timestamp((SELECT max(timestamp) FROM ticks) * 1000000), '%Y-%m-%d %H:%M:%S') AS updated FROM kept)""")
        + f"""SELECT kind, sat_id, popup, lon, lat, title, updated FROM (
        SELECT 'path' AS kind, sat_id, first_name || ' Path' AS popup, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat FROM ends
        UNION ALL SELECT 'head', sat_id, first_name || ' (ID: ' || sat_id || ')' || chr(10) || 'Window: ' || {_HHMM('window_start')} || ' to ' || {_HHMM('window_end')},
          longitude, latitude FROM ends
        UNION ALL SELECT 'observer', NULL, 'Observer: Bangalore', 77.60329, 12.97623), texts""",
})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
