"""Streaming readers.

Every reader returns raw records ``value, topic, partition, offset`` so the batch
parsers (``groundtrack.operators.ingest``) apply unchanged. A message
broker source needs its connector package on the classpath; file sources
(parquet / JSON lines with the same columns; ``partition`` may be missing) need nothing and are
what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundtrack.params import REQUEST_TOPIC, TOPIC_PREFIX
from groundtrack.schemas import RAW

RAW_WITH_OFFSET = T.StructType(RAW.fields + [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])
POSITION_TOPICS = TOPIC_PREFIX + r"\d+"    # subscribePattern (whole-name match)


def read_broker(spark: SparkSession, servers: str, *, pattern: str | None = None,
                topic: str | None = None, starting: str = "latest", **options) -> DataFrame:
    """Kafka-compatible source: ``subscribePattern`` (all position topics)
    or ``subscribe`` (one topic). Offsets are tracked by the query's
    checkpoint, so a restart resumes where it stopped."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("startingOffsets", starting))
    r = r.option("subscribePattern", pattern) if pattern else r.option("subscribe", topic)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_positions(spark: SparkSession, servers: str, **kw) -> DataFrame:
    return read_broker(spark, servers, pattern=POSITION_TOPICS, **kw)


def read_requests(spark: SparkSession, servers: str, **kw) -> DataFrame:
    return read_broker(spark, servers, topic=REQUEST_TOPIC, **kw)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of raw-record files as a stream (new files = new data)."""
    r = spark.readStream.schema(RAW_WITH_OFFSET).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
