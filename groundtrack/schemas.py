"""Explicit schemas: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# A position fix as published on the per-object topics.
POSITION = T.StructType([
    T.StructField("sat_id", T.StringType()),
    T.StructField("satname", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("azimuth", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
])
POSITION_FIELDS = [f.name for f in POSITION.fields]

# An observer request. ``obs_`` keeps the names apart from position fields.
REQUEST = T.StructType([
    T.StructField("obs_latitude", T.DoubleType()),
    T.StructField("obs_longitude", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("choice_id", T.IntegerType()),
])
REQUEST_FIELDS = [f.name for f in REQUEST.fields]

# The positions API document: {info: {satname}, positions: [{...}]}.
API_POSITION = T.StructType([
    T.StructField("satlatitude", T.DoubleType()),
    T.StructField("satlongitude", T.DoubleType()),
    T.StructField("azimuth", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])
API_DOC = T.StructType([
    T.StructField("info", T.StructType([T.StructField("satname", T.StringType())])),
    T.StructField("positions", T.ArrayType(API_POSITION)),
])

# Raw records as a message source delivers them.
RAW = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
])

CLOSEST_RESPONSE = T.StructType([
    T.StructField("satname", T.StringType()),
    T.StructField("sat_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("observer_lat", T.DoubleType()),
    T.StructField("observer_lon", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

OVERLAP_ITEM = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("satname1", T.StringType()),
    T.StructField("satname2", T.StringType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("overlap", T.BooleanType()),
    T.StructField("overlap_km", T.DoubleType()),
    T.StructField("lat1", T.DoubleType()),
    T.StructField("lon1", T.DoubleType()),
    T.StructField("lat2", T.DoubleType()),
    T.StructField("lon2", T.DoubleType()),
])
OVERLAP_RESPONSE = T.ArrayType(OVERLAP_ITEM)

MOTION_ITEM = T.StructType([
    T.StructField("sat_id", T.StringType()),
    T.StructField("satname", T.StringType()),
    T.StructField("velocity_kmph", T.DoubleType()),
    T.StructField("direction", T.StructType([
        T.StructField("delta_latitude", T.DoubleType()),
        T.StructField("delta_longitude", T.DoubleType()),
    ])),
    T.StructField("timestamp", T.LongType()),
])
MOTION_RESPONSE = T.ArrayType(MOTION_ITEM)
