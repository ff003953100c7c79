"""Geometry of the one recorded output of the original application: the
last points of five tracks (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from groundtrack.functions.geo import haversine_km
from groundtrack.operators import asof, overlap
from groundtrack.params import OBSERVER

LAST = [("49810", -45.09722576, -155.26624577), ("43566", 8.71776189, 159.1162731),
        ("43056", -50.44770802, 167.61267156), ("41550", 55.14343392, -51.24856081),
        ("41174", 55.18026518, -155.58166636)]
TO_OBSERVER = {"49810": 13904.79, "43566": 8879.15, "43056": 11116.83, "41550": 11064.28,
               "41174": 10960.89}
PAIRS = {("41174", "41550"): (5964.36, False, 0.0), ("41174", "43056"): (12230.39, False, 0.0),
         ("41174", "43566"): (6513.03, False, 0.0), ("41174", "49810"): (11150.39, False, 0.0),
         ("41550", "43056"): (17386.59, False, 0.0), ("41550", "43566"): (12374.64, False, 0.0),
         ("41550", "49810"): (14762.40, False, 0.0), ("43056", "43566"): (6630.03, False, 0.0),
         ("43056", "49810"): (2806.17, True, 2193.83), ("43566", "49810"): (7519.45, False, 0.0)}


@pytest.fixture()
def last(spark):
    rows = [(s, f"Sat {s}", la, lo, 0.0, 0.0, 1745231681, i) for i, (s, la, lo) in enumerate(LAST)]
    return spark.createDataFrame(rows, "sat_id string, satname string, latitude double, longitude double, "
                                       "azimuth double, elevation double, timestamp bigint, seq bigint")


def test_distance_to_observer(last):
    d = last.select("sat_id", F.round(haversine_km(F.lit(OBSERVER[0]), F.lit(OBSERVER[1]),
                                                    "latitude", "longitude"), 2).alias("d"))
    assert {r.sat_id: r.d for r in d.collect()} == TO_OBSERVER


def test_closest_is_43566(spark, last):
    req = spark.createDataFrame([(1, OBSERVER[0], OBSERVER[1], 1745231700, 3)],
                                "request_id long, obs_latitude double, obs_longitude double, "
                                "timestamp long, choice_id int")
    r = asof.closest_satellite(req, last).collect()
    assert [(x.sat_id, x.distance_km) for x in r] == [("43566", 8879.15)]


def test_pairs(last):
    got = {(r.sat_id1, r.sat_id2): (r.distance_km, r.overlap, r.overlap_km)
           for r in overlap.coverage_overlap(last).collect()}
    assert got == PAIRS
