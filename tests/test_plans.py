"""Physical plan checks: native expressions, no nested loops, pruning."""

import pytest

import __spark_entry__ as E
from groundtrack.operators import asof, overlap, tracks
from groundtrack.params import EARTH_RADIUS_KM
from groundtrack.plans.streams import STREAM_QUERIES
from groundtrack.sources import fixtures as fx
from groundtrack.streaming import sinks

from conftest import SF_SMALL

BATCH = sorted(k for k in E.oracle_sql() if k not in STREAM_QUERIES)
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_python_and_no_nested_loops(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in p, (key, bad)


def test_overlap_is_an_equi_join(spark):
    p = plan(E.queries()["coverage_overlap"](spark, SF_SMALL))
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p or "BroadcastHashJoin" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["coverage_overlap"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint>" in p


def test_history_read_prunes_partitions(spark, scratch):
    sinks.history_append(fx.ticks(spark, SF_SMALL), 0, f"{scratch}/h", sat_id=None)
    df = tracks.history_path(sinks.read_history(spark, f"{scratch}/h", 0, 2 * 10 ** 9))
    p = plan(df)
    assert "isnotnull(day#" in p.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "(sat_id#" in p and "= 49810)" in p
    assert "azimuth" not in p.split("ReadSchema:")[1].split("\n")[0]
    assert df.count() == 200


def test_hot_objects_are_split_by_time(spark):
    """Motion and as-of windows partition by (object, time chunk/bucket),
    never by the object alone."""
    import re
    m = plan(E.queries()["motion_vectors"](spark, SF_SMALL))
    assert re.search(r"hashpartitioning\(sat_id#\d+, _c#\d+L?", m), m
    a = plan(E.queries()["asof_positions"](spark, SF_SMALL))
    assert re.search(r"hashpartitioning\(_e#\d+, b#\d+L?", a), a


def test_asof_aggregates_are_hash_based(spark):
    p = plan(E.queries()["asof_positions"](spark, SF_SMALL))
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_overlapping_only_joins_on_places(spark):
    """Latitude bands for few objects, cells on the sphere for many."""
    p = plan(E.queries()["coverage_overlap_hits"](spark, SF_SMALL))
    assert "SortMergeJoin" in p and "_band" in p.split("SortMergeJoin")[1].split("\n")[0]
    p = plan(overlap.coverage_overlap(fx.ticks_n(spark, SF_SMALL, 50), only_overlapping=True, objects=10**6))
    assert "c_x" in p.split("SortMergeJoin")[1].split("\n")[0]


def test_retention_stands_below_the_windows(spark):
    """Old fixes are dropped before the first shuffle of the track queries."""
    for key in ("tracks", "track_retention", "track_legend"):
        lines = plan(E.queries()[key](spark, SF_SMALL)).split("\n")
        deepest = max(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
        assert any("Filter " in x and "ubquery" in x for x in lines[deepest:]), key


def test_rounds_of_closest_search_do_not_nest(spark):
    """Each round of the expanding cells reads what the one before wrote."""
    p = E.queries()["closest_many"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Join") <= 3 and "Union" in p


def test_closest_search_broadcasts_no_requests(spark, scratch, monkeypatch):
    """Requests, their copies to cells and objects grow together: small tables
    too are joined without sending a side of them to the driver."""
    from math import asin, cos, radians, sin, sqrt

    seen = [(t, str(k), f"Sat {k}", (k * 37 + t * 11) % 160 - 80.0, (k * 61 + t * 7) % 360 - 180.0, t, k) for t in (100, 118) for k in range(60)]
    asked = [(i, (i * 53) % 180 - 90.0, (i * 97) % 360 - 180.0, 100 + 18 * (i % 2)) for i in range(150)]
    spark.createDataFrame(seen, "request_ts bigint, sat_id string, satname string, latitude double, longitude double, fix_ts bigint, fix_seq bigint"
                          ).write.parquet(f"{scratch}/seen")
    spark.createDataFrame(asked, "request_id bigint, obs_latitude double, obs_longitude double, timestamp bigint").write.parquet(f"{scratch}/asked")
    rows, reqs = spark.read.parquet(f"{scratch}/seen"), spark.read.parquet(f"{scratch}/asked")       # of a known, small size
    plans, kind = [], type(rows)
    written = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *a, **k: plans.append(plan(df)) or written(df, *a, **k))
    found = asof.closest_satellite(reqs, rows.withColumnRenamed("request_ts", "timestamp"), seen=rows, digits=6)
    plans.append(plan(found))
    assert len(plans) >= 4 and sum("SortMergeJoin" in p for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)

    def km(a, b, c, d):
        h = sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2
        return 2 * EARTH_RADIUS_KM * asin(min(1.0, sqrt(h)))

    best = {r.request_id: r.distance_km for r in found.collect()}
    assert best == {i: pytest.approx(min(km(la, lo, s[3], s[4]) for s in seen if s[0] == t), abs=1e-5) for i, la, lo, t in asked}
