"""Operators against plain Python loops on random inputs (several seeds).

The loops state the semantics directly; the Spark plans must agree row for
row, including equal seconds, chunk edges and look-back borders.
"""

import math
import random

import pytest

from groundtrack.operators import asof, motion, overlap, windows

POS = ("sat_id string, satname string, latitude double, longitude double, azimuth double, "
       "elevation double, timestamp bigint, seq bigint")
REQ = "request_id long, obs_latitude double, obs_longitude double, timestamp long, choice_id int"
R = 6371.0


def hav(la1, lo1, la2, lo2):
    p1, p2 = math.radians(la1), math.radians(la2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        (math.radians(lo2) - math.radians(lo1)) / 2) ** 2
    return 2 * R * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))


def random_fixes(seed, n=300, sats=4, span=2000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = str(rnd.randint(1, sats))
        rows.append((s, f"Sat {s}", round(rnd.uniform(-80, 80), 2), round(rnd.uniform(-180, 180), 2),
                     0.0, 0.0, rnd.randint(0, span), i))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_motion_vectors_equal_loop(spark, seed):
    rows = random_fixes(seed)
    got = {r.seq: (r.prev_timestamp, r.velocity_kmph, r.delta_latitude, r.delta_longitude)
           for r in motion.motion_vectors(spark.createDataFrame(rows, POS), lookback_s=300,
                                          chunk_s=700).collect()}
    want = {}
    by_sat = {}
    for r in sorted(rows, key=lambda r: (r[6], r[7])):
        by_sat.setdefault(r[0], []).append(r)
    for seq_rows in by_sat.values():
        for i, cur in enumerate(seq_rows):
            held = [p for p in seq_rows[: i + 1] if cur[6] - p[6] <= 300]
            if len(held) < 2:
                continue
            prev = held[0]
            dt = cur[6] - prev[6]
            if dt == 0:
                v = (prev[6], 0.0, 0.0, 0.0)
            else:
                v = (prev[6], round(hav(prev[2], prev[3], cur[2], cur[3]) / (dt / 3600), 2),
                     round(cur[2] - prev[2], 5), round(cur[3] - prev[3], 5))
            want[cur[7]] = v
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0]
        assert all(abs(a - b) <= 0.0100001 for a, b in zip(got[k][1:], want[k][1:])), (k, got[k], want[k])


@pytest.mark.parametrize("seed", [4, 5])
def test_overlap_equals_loop(spark, seed):
    rows = random_fixes(seed, n=200, sats=6, span=30)
    got = {(r.timestamp, r.sat_id1, r.sat_id2, r.lat1, r.lat2): (r.distance_km, r.overlap)
           for r in overlap.coverage_overlap(spark.createDataFrame(rows, POS)).collect()}
    n = 0
    for a in rows:
        for b in rows:
            if a[6] == b[6] and a[0] < b[0]:
                d = hav(a[2], a[3], b[2], b[3])
                n += 1
                k = (a[6], a[0], b[0], a[2], b[2])
                assert abs(got[k][0] - d) < 0.0051 and got[k][1] == (d < 5000)
    assert n == len(got)


@pytest.mark.parametrize("seed", [6, 7])
def test_sliding_equals_loop(spark, seed):
    rows = random_fixes(seed, n=150, sats=3, span=4000)
    got = {(r.window_start, r.sat_id): (r.latitude, r.longitude, r.timestamp)
           for r in windows.sliding_positions(spark.createDataFrame(rows, POS)).collect()}
    want = {}
    for r in rows:
        t = r[6]
        first = t - t % 120
        for ws in range(first - 1680, first + 1, 120):
            k = (ws, r[0])
            best = want.get(k)
            if best is None or (r[6], r[7]) > (best[2], best[3]):
                want[k] = (r[2], r[3], r[6], r[7])
    assert got == {k: v[:3] for k, v in want.items()}


@pytest.mark.parametrize("seed", [8, 9])
def test_closest_equals_loop(spark, seed):
    rows = random_fixes(seed, n=200, sats=5, span=20000)
    rnd = random.Random(seed)
    reqs = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.randint(0, 22000), 3) for i in range(80)]
    got = {r.request_id: (r.sat_id, r.distance_km)
           for r in asof.closest_satellite(spark.createDataFrame(reqs, REQ), spark.createDataFrame(rows, POS),
                                           lookback_s=3600).collect()}
    want = {}
    for rid, la, lo, rt, _ in reqs:
        latest = {}
        for r in rows:
            if rt - 3600 <= r[6] <= rt and (r[0] not in latest or (r[6], r[7]) > latest[r[0]][:2]):
                latest[r[0]] = (r[6], r[7], r[2], r[3])
        if latest:
            d, s = min((hav(la, lo, v[2], v[3]), s) for s, v in latest.items())
            want[rid] = (s, round(d, 2))
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) <= 0.0100001


@pytest.mark.parametrize("cell", [5, 10, 30])
def test_closest_grid_prefilter_is_exact(spark, cell):
    rnd = random.Random(cell)
    objs = [(str(i), f"Sat {i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180), 0.0, 0.0,
             1000 + 10 * (i % 3), i) for i in range(400)]
    objs += [("p1", "Sat p1", 89.9, 10.0, 0.0, 0.0, 1000, 1000), ("p2", "Sat p2", -90.0, 180.0, 0.0, 0.0, 1000, 1001)]
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(250)]
    pts += [(89.99, -170.0), (-89.5, 179.9), (0.0, 180.0), (0.0, -180.0), (45.0, 179.99)]
    reqs = [(i, la, lo, 1000 + 10 * (i % 4), 3) for i, (la, lo) in enumerate(pts)]
    f = spark.createDataFrame(objs, POS)
    r = spark.createDataFrame(reqs, REQ)
    got = {x.request_id: (x.sat_id, x.distance_km)
           for x in asof.closest_satellite(r, f, lookback_s=3600, cell_deg=cell).collect()}
    plain = {x.request_id: (x.sat_id, x.distance_km)
             for x in asof.closest_satellite(r, f, lookback_s=3600).collect()}
    assert got == plain
    for rid, la, lo, rt, _ in reqs:
        c = [(hav(la, lo, o[2], o[3]), o[0]) for o in objs if rt - 3600 <= o[6] <= rt]
        d, s = min(c)
        assert got[rid][0] == s and abs(got[rid][1] - d) <= 0.0051


@pytest.mark.parametrize("radius", [300.0, 2500.0, 6000.0])
def test_overlapping_only_equals_filtered_all_pairs(spark, radius):
    rows = random_fixes(int(radius), n=300, sats=40, span=5)
    f = spark.createDataFrame(rows, POS)
    want = sorted(map(tuple, overlap.coverage_overlap(f, radius_km=radius).where("overlap").collect()))
    got = sorted(map(tuple, overlap.coverage_overlap(f, radius_km=radius, only_overlapping=True).collect()))
    assert got == want
    n = sum(1 for a in rows for b in rows if a[6] == b[6] and a[0] < b[0]
            and hav(a[2], a[3], b[2], b[3]) < 2 * radius)
    assert len(got) == n


@pytest.mark.parametrize("L", [60, 100, 3600])
def test_asof_bucket_boundaries(spark, L):
    """Fixes and requests exactly on and around bucket edges b*L."""
    ts = sorted({t for b in range(1, 5) for t in (b * L - 1, b * L, b * L + 1)})
    fx_rows = [(str(1 + i % 2), f"Sat {1 + i % 2}", float(i), float(i), 0.0, 0.0, t, i) for i, t in enumerate(ts)]
    fx_rows += [("1", "Sat 1", 99.0, 99.0, 0.0, 0.0, ts[3], 1000)]          # equal second, later seq
    reqs = [(j, 0.0, 0.0, t, 3) for j, t in enumerate(sorted({t + d for t in ts for d in (-1, 0, 1)}))]
    got = {(r.request_id, r.sat_id): r.fix_seq for r in asof.asof_positions(
        spark.createDataFrame(reqs, REQ), spark.createDataFrame(fx_rows, POS), lookback_s=L).collect()}
    want = {}
    for rid, _, _, rt, _ in reqs:
        for s in ("1", "2"):
            c = [(t, q) for sid, _, _, _, _, _, t, q in fx_rows if sid == s and rt - L <= t <= rt]
            if c:
                want[(rid, s)] = max(c)[1]
    assert got == want


def test_motion_chunk_boundaries(spark):
    """Fixes exactly around chunk edges c*C and the context border c*C - L."""
    C, L = 1000, 300
    ts = sorted({t for c in range(1, 4) for t in (c * C - L - 1, c * C - L, c * C - L + 1, c * C - 1, c * C,
                                                    c * C + 1, c * C + 299, c * C + 300)})
    rows = [("1", "Sat 1", float(i) / 10, float(i) / 10, 0.0, 0.0, t, i) for i, t in enumerate(ts)]
    rows += [("1", "Sat 1", 5.0, 5.0, 0.0, 0.0, 2 * C, 500)]                 # equal second at an edge
    got = {r.seq: r.prev_timestamp
           for r in motion.motion_vectors(spark.createDataFrame(rows, POS), L, chunk_s=C).collect()}
    want = {}
    order = sorted(rows, key=lambda r: (r[6], r[7]))
    for i, cur in enumerate(order):
        held = [p for p in order[: i + 1] if cur[6] - p[6] <= L]
        if len(held) >= 2:
            want[cur[7]] = held[0][6]
    assert got == want


def test_closest_auto_grid(spark):
    rnd = random.Random(21)
    many = [(str(i), f"Sat {i}", rnd.uniform(-80, 80), rnd.uniform(-180, 180), 0.0, 0.0, 1000, i)
            for i in range(300)]
    reqs = spark.createDataFrame([(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180), 1000, 3) for i in range(100)], REQ)
    for objs in (many[:5], many):
        f = spark.createDataFrame(objs, POS)
        a = sorted(map(tuple, asof.closest_satellite(reqs, f, cell_deg=30).collect()))
        b = sorted(map(tuple, asof.closest_satellite(reqs, f).collect()))
        assert a == b and len(a) == 100
