"""Position and request views derived from the ``events`` table.

The test data has no satellite tables, so fixes and requests are computed
from ``events`` columns by fixed integer rules (see FIXTURES.md §2). Work
grows with ``events``: every view is a projection of it, no rows are
generated on the driver.

Columns of a positions view: sat_id, satname, latitude, longitude, azimuth,
elevation, timestamp (epoch s), seq (ingest order, unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.functions.timefn import epoch_seconds
from groundtrack.operators.codecs import encode_requests
from groundtrack.params import SAT_IDS, TOPIC_PREFIX
from groundtrack.sources.tables import table

# --- fixed values of the fixture rules ---------------------------------------
BASE_EPOCH = 1745211600    # first poll of ``ticks`` (epoch seconds)
POLL_S = 18                # seconds between polls
LAT_STEP, LAT_K, LAT_MOD = 37, 2900, 16000
LON_STEP, LON_K, LON_MOD = 61, 7100, 36000
OBS_LAT_STEP, OBS_LON_STEP = 53, 97
# event_type -> request choice_id
CHOICE_OF_EVENT = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 9}
AZ_STEP, EL_STEP = 7919, 104729
# --- end of fixed values -----------------------------------------------------


def _lat(tick: Column, k: Column) -> Column:
    return ((tick * LAT_STEP + k * LAT_K) % LAT_MOD).cast("double") / 100 - 80


def _lon(tick: Column, k: Column) -> Column:
    return ((tick * LON_STEP + k * LON_K) % LON_MOD).cast("double") / 100 - 180


def _named(k: Column) -> tuple[Column, Column]:
    sat_id = F.element_at(F.array(*[F.lit(s) for s in SAT_IDS]), (k + 1).cast("int"))
    return sat_id, F.concat(F.lit("Sat "), sat_id)


def _finish(df: DataFrame, sat_id: Column, satname: Column, ts: Column,
            lat: Column, lon: Column, *extra: str) -> DataFrame:
    return df.select(*extra,
        sat_id.alias("sat_id"), satname.alias("satname"),
        lat.alias("latitude"), lon.alias("longitude"),
        (((F.col("event_id") * AZ_STEP) % 3_600_000).cast("double") / 9973).alias("azimuth"),
        (((F.col("event_id") * EL_STEP) % 900_000).cast("double") / 9973).alias("elevation"),
        ts.cast("bigint").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


def _ticks_cols(ev: DataFrame) -> DataFrame:
    k = F.col("event_id") % len(SAT_IDS)
    tick = F.expr(f"event_id div {len(SAT_IDS)}")
    sat_id, satname = _named(k)
    return _finish(ev, sat_id, satname, F.lit(BASE_EPOCH) + tick * POLL_S,
                   _lat(tick, k), _lon(tick, k))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five objects polled together every 18 s."""
    return _ticks_cols(table(spark, sf_dir, "events", "event_id"))


def ticks_n(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``n`` objects polled together every 18 s (ids '0'..'n-1')."""
    ev = table(spark, sf_dir, "events", "event_id")
    k = F.col("event_id") % n
    tick = F.expr(f"event_id div {int(n)}")
    sat_id = k.cast("string")
    return _finish(ev, sat_id, F.concat(F.lit("Sat "), sat_id),
                   F.lit(BASE_EPOCH) + tick * POLL_S, _lat(tick, k), _lon(tick, k))


def irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uneven gaps and equal-second fixes: time from ``events.ts``."""
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    k = F.col("user_id") % len(SAT_IDS)
    sat_id, satname = _named(k)
    eid = F.col("event_id")
    return _finish(ev, sat_id, satname, epoch_seconds("ts"), _lat(eid, k), _lon(eid, k))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observer requests: one per event, ``request_id`` = event_id."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    eid = F.col("event_id")
    choice = F.lit(None).cast("int")
    for name, c in CHOICE_OF_EVENT.items():
        choice = F.when(F.col("event_type") == name, F.lit(c)).otherwise(choice)
    return ev.select(
        eid.alias("request_id"),
        (((eid * OBS_LAT_STEP) % 18000).cast("double") / 100 - 90).alias("obs_latitude"),
        (((eid * OBS_LON_STEP) % 36000).cast("double") / 100 - 180).alias("obs_longitude"),
        F.col("value").alias("altitude"),
        epoch_seconds("ts").alias("timestamp"),
        choice.alias("choice_id"),
    )


def raw_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position messages as a message source would deliver them.

    ``value`` is the JSON text of a ``ticks`` fix with an integer ``sat_id``
    (as the producer writes it); events of type 'error' carry their ``props``
    text instead, which has none of the position fields (junk to quarantine).
    ``offset`` stands in for the source offset (ingest order).
    """
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "props")
    k = F.col("event_id") % len(SAT_IDS)
    tick = F.expr(f"event_id div {len(SAT_IDS)}")
    sat_id, satname = _named(k)
    j = _finish(ev, sat_id, satname, F.lit(BASE_EPOCH) + tick * POLL_S,
                _lat(tick, k), _lon(tick, k), "event_type", "props")
    body = F.to_json(F.struct(
        F.col("sat_id").cast("int").alias("sat_id"), "satname", "latitude", "longitude",
        "azimuth", "elevation", "timestamp"))
    return j.select(
        F.when(F.col("event_type") == "error", F.col("props")).otherwise(body).alias("value"),
        F.concat(F.lit(TOPIC_PREFIX), F.col("sat_id")).alias("topic"),
        F.col("seq").alias("offset"),
    )


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages: JSON of ``requests`` rows, as the request encoder
    writes them (with the null unprefixed ``latitude``/``longitude`` keys the
    original client sends); an unknown choice is sent as a null
    ``choice_id``."""
    r = requests(spark, sf_dir).withColumn(
        "choice_id", F.when(F.col("choice_id") != 9, F.col("choice_id")))
    m = encode_requests(r.withColumn("offset", F.col("request_id")))
    return m.select("value", "topic", F.col("key").cast("bigint").alias("offset"))


def api_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions API documents for the ``ticks`` fixes, with the requested id.

    Events of type 'error' answer with an empty ``positions`` list and
    'signup' events with no ``info`` object, the two cases the normaliser
    must survive.
    """
    ev = table(spark, sf_dir, "events", "event_id", "event_type")
    k = F.col("event_id") % len(SAT_IDS)
    tick = F.expr(f"event_id div {len(SAT_IDS)}")
    sat_id, satname = _named(k)
    t = _finish(ev, sat_id, satname, F.lit(BASE_EPOCH) + tick * POLL_S,
                _lat(tick, k), _lon(tick, k), "event_type")
    pos = F.struct(F.col("latitude").alias("satlatitude"), F.col("longitude").alias("satlongitude"),
                   "azimuth", "elevation", "timestamp")
    positions = F.when(F.col("event_type") == "error", F.array().cast("array<struct<satlatitude:double,"
                       "satlongitude:double,azimuth:double,elevation:double,timestamp:bigint>>")
                       ).otherwise(F.array(pos))
    with_info = F.to_json(F.struct(F.struct("satname").alias("info"), positions.alias("positions")))
    no_info = F.to_json(F.struct(positions.alias("positions")))
    value = F.when(F.col("event_type") == "signup", no_info).otherwise(with_info)
    return t.select(F.col("sat_id").cast("int").alias("sat_id"), value.alias("value"),
                    F.col("seq"))
