"""Cells on the sphere, interpolation and map geometry against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from groundtrack.functions import sphere
from groundtrack.operators import asof, interpolate, overlap, tracks
from groundtrack.sources import fixtures as fx

from conftest import SF_SMALL

POS = ("sat_id string, satname string, latitude double, longitude double, azimuth double, "
       "elevation double, timestamp bigint, seq bigint")


def vec(lat, lon):
    p, q = math.radians(lat), math.radians(lon)
    return (math.cos(p) * math.cos(q), math.cos(p) * math.sin(q), math.sin(p))


def angle(a, b):
    return 2 * math.asin(min(1.0, math.dist(a, b) / 2))


def scattered(seed, n):
    rnd = random.Random(seed)
    pts = [(math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180)) for _ in range(n)]
    return pts + [(90.0, 0.0), (-90.0, 50.0), (89.999, -170.0), (0.0, 180.0), (0.0, -180.0), (12.0, 179.9), (12.0, -179.9), (0.0, 0.0)]


def points(spark, pts, t=1000):
    return spark.createDataFrame([(str(i), f"Sat {i}", la, lo, 0.0, 0.0, t, i) for i, (la, lo) in enumerate(pts)], POS)


@pytest.mark.parametrize("radius", [2500.0, 800.0, 100.0, 1.0, 11000.0])
def test_overlapping_pairs_by_cells(spark, radius):
    pts = scattered(int(radius), 150) + [(10.0 + i * 0.001, 20.0) for i in range(20)]
    f = points(spark, pts)
    got, bands = ({(r.sat_id1, r.sat_id2) for r in overlap.coverage_overlap(f, radius, only_overlapping=True, objects=n).collect()} for n in (10**6, 1))
    assert got == bands
    v = [vec(*p) for p in pts]
    want = {tuple(sorted((str(i), str(j)))) for i in range(len(pts)) for j in range(i) if angle(v[i], v[j]) * 6371.0 < 2 * radius}
    assert got == want


def test_cells_leave_few_candidates(spark):
    """Pairs that share a cell are a small multiple of the overlapping ones."""
    for radius, times in ((250.0, 4.0), (800.0, 4.0), (2500.0, 4.0)):
        f = points(spark, scattered(3, 600))
        a = f.select(*[F.col(c).alias(f"{c}_a") for c in ("sat_id", "latitude", "longitude")])
        b = f.select(*[F.col(c).alias(f"{c}_b") for c in ("sat_id", "latitude", "longitude")])
        line = sphere.chord(2 * radius / 6371.0)
        a = a.select("*", *sphere.unit_vector("latitude_a", "longitude_a", "p_"))
        b = b.select("*", *sphere.unit_vector("latitude_b", "longitude_b", "q_"))
        a, b = overlap.in_cells(a, b, line, line / overlap.CELLS_PER_REACH)
        cond = [F.col(f"c_{x}") == F.col(f"d_{x}") for x in sphere.AXES]
        met = a.join(b, [*cond, F.col("sat_id_a") < F.col("sat_id_b")]).count()
        hits = overlap.coverage_overlap(f, radius, only_overlapping=True).count()
        assert hits <= met <= times * hits + 50, (radius, met, hits)


@pytest.mark.parametrize("cell", [None, 3, 40, 170])
def test_closest_by_expanding_cells(spark, cell):
    pts, asked = scattered(1, 200), scattered(2, 120)
    r = spark.createDataFrame([(i, la, lo, 0.0, 1000 + i % 2, 3) for i, (la, lo) in enumerate(asked)],
                              "request_id long, obs_latitude double, obs_longitude double, altitude double, timestamp long, choice_id int")
    got = {x.request_id: (x.sat_id, x.distance_km) for x in asof.closest_satellite(r, points(spark, pts), cell_deg=cell, digits=6).collect()}
    for i, p in enumerate(asked):
        d, s = min((round(angle(vec(*p), vec(*q)) * 6371.0, 6), str(j)) for j, q in enumerate(pts))
        assert got[i][0] == s or abs(got[i][1] - d) < 1e-5
        assert abs(got[i][1] - d) < 1e-4


def test_closest_compares_few(spark):
    """With 500 objects a request meets a few of them, polar ones included."""
    objects = points(spark, scattered(5, 500)).select(F.col("timestamp").alias("request_ts"), "sat_id", "latitude", "longitude",
                                                      *sphere.unit_vector("latitude", "longitude", "o_"))
    asked = scattered(6, 400) + [(88.0 + i / 100, 3.0 * i) for i in range(100)]
    r = spark.createDataFrame([(i, la, lo, 1000) for i, (la, lo) in enumerate(asked)], "request_id long, obs_latitude double, obs_longitude double, request_ts long")
    r = r.select("*", *sphere.unit_vector("obs_latitude", "obs_longitude", "r_"))
    width = 2 * math.sqrt(asof.NEAR / 508)
    assert asof._candidates(r, objects, width).count() < 25 * len(asked)
    with pytest.raises(ValueError):
        asof.closest_satellite(fx.requests(spark, SF_SMALL), fx.ticks(spark, SF_SMALL), cell_deg=0)


# -- interpolation -----------------------------------------------------------

def slerp(a, b, f):
    w = angle(a, b)
    if w < 1e-12:
        return a
    return tuple((math.sin((1 - f) * w) * x + math.sin(f * w) * y) / math.sin(w) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("chunk", [500, 10**6])
def test_positions_at_equal_loop(spark, chunk):
    rnd = random.Random(9)
    rows = [(s, f"Sat {s}", rnd.uniform(-89, 89), rnd.uniform(-180, 180), 0.0, 0.0, rnd.randint(0, 6000), i) for i, s in enumerate("ab" * 60)]
    rows += [("c", "Sat c", 10.0, 179.0, 0.0, 0.0, 100, 900), ("c", "Sat c", 10.0, -179.0, 0.0, 0.0, 200, 901), ("c", "Old c", 0.0, 0.0, 0.0, 0.0, 200, 5),
             ("d", "Sat d", 0.0, 0.0, 0.0, 0.0, 60, 902), ("d", "Sat d", 0.0, 180.0, 0.0, 0.0, 180, 903), ("e", "Sat e", None, 0.0, 0.0, 0.0, 60, 904),
             ("f", "Sat f", 1.0, 2.0, 0.0, 0.0, 61, 905)]
    got = {(r.sat_id, r.timestamp): (r.latitude, r.longitude, r.exact) for r in
           interpolate.positions_at(spark.createDataFrame(rows, POS), 60, 300, chunk_s=chunk).collect()}
    want = {}
    for s in "abcdf":
        last = {}
        for r in sorted((r for r in rows if r[0] == s and r[2] is not None), key=lambda r: (r[6], r[7])):
            last[r[6]] = (r[2], r[3])
        ts = sorted(last)
        for i, t in enumerate(ts):
            if t % 60 == 0:
                want[s, t] = last[t]
            if i + 1 < len(ts) and ts[i + 1] - t <= 300:
                a, b = vec(*last[t]), vec(*last[ts[i + 1]])
                if angle(a, b) < math.pi - 1e-6:
                    for u in range(t + 1, ts[i + 1]):
                        if u % 60 == 0:
                            x, y, z = slerp(a, b, (u - t) / (ts[i + 1] - t))
                            want[s, u] = (math.degrees(math.atan2(z, math.hypot(x, y))), math.degrees(math.atan2(y, x)))
    assert set(got) == set(want)
    for k, (la, lo) in want.items():
        assert angle(vec(la, lo), vec(*got[k][:2])) < 1e-9
    assert abs(got["c", 180][1]) > 179 and got["d", 60][2]


def test_objects_a_second_apart_are_paired(spark):
    rows = [(s, s, 10.0 + k, 0.1 * t, 0.0, 0.0, 18 * t + k, 10 * t + k) for k, s in enumerate("xyz") for t in range(20)]
    f = spark.createDataFrame(rows, POS)
    assert overlap.coverage_overlap(f).count() == 0
    out = interpolate.overlap_within(f, 18, 30).collect()
    assert len(out) == 3 * 19 and all(r.overlap for r in out)         # from the second poll, before which y and z are not known


# -- map geometry ------------------------------------------------------------

TR = "sat_id string, satname string, n_points int, path array<struct<window_start:bigint,window_end:bigint,timestamp:bigint,latitude:double,longitude:double>>"


def track(spark, pts):
    return spark.createDataFrame([("1", "Sat 1", len(pts), [(i, i + 9, i, float(la), float(lo)) for i, (la, lo) in enumerate(pts)])], TR)


def test_lines_are_cut_at_the_antimeridian(spark):
    t = track(spark, [(0, 170), (10, -170), (20, -160), (30, 179), (40, 180), (50, -180)])
    lines = tracks.track_lines(t).first().lines
    assert lines == [[[170, 0], [180, 5]], [[-180, 5], [-170, 10], [-160, 20], [-180, 20 + 10 * 20 / 21]], [[180, 20 + 10 * 20 / 21], [179, 30], [180, 40], [180, 40]],
                     [[-180, 40], [-180, 50]]]
    for line in lines:
        assert all(abs(a[0] - b[0]) <= 180 for a, b in zip(line, line[1:], strict=False))
    assert tracks.track_lines(track(spark, [])).first().lines == []


@pytest.mark.parametrize("tolerance", [0.0, 5.0, 100.0, 1500.0])
def test_simplified_paths_keep_to_the_tolerance(spark, tolerance):
    rnd = random.Random(int(tolerance))
    pts = [(50 * math.sin(i / 5) + rnd.uniform(-1, 1), (170 + 4 * i + rnd.uniform(-1, 1) + 180) % 360 - 180) for i in range(40)] + [(0, 0), (0, 0), (0, 1), (0, 2), (0, 3)]
    kept = [(p.latitude, p.longitude, p.timestamp) for p in tracks.simplify(track(spark, pts), tolerance).first().path]
    assert kept[0][2] == 0 and kept[-1][2] == len(pts) - 1 and [k[2] for k in kept] == sorted({k[2] for k in kept})
    assert len(kept) < len(pts)
    for a, b in zip(kept, kept[1:], strict=False):
        va, vb = vec(*a[:2]), vec(*b[:2])
        for i in range(a[2] + 1, b[2]):
            p = vec(*pts[i])
            near = min(angle(p, slerp(va, vb, f / 2000)) for f in range(2001))
            assert near * 6371.0 <= tolerance + angle(va, vb) * 6371.0 / 4000 + 1e-3
    assert tracks.simplify(track(spark, pts[:2]), tolerance).first().n_points == 2
