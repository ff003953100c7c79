"""Message encoders and response builders.

Outgoing messages are ``(topic, key, value)`` rows with JSON text values, so
they can go to any sink (a message topic through ``writeStream``, files, a
table). Responses are keyed by ``request_id``: each request gets its own
answer, whatever else arrived in the same micro-batch.

Every answer carries ``part`` and ``n_parts`` (0 and 1 for a single message):
a list of more than ``MAX_ITEMS`` items is spread over several messages of
one key, so that no message grows with the number of objects, and a reader
always knows whether it has the whole answer (``whole_answers``).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from groundtrack.params import MOTION_TOPIC, REQUEST_TOPIC, RESPONSE_TOPIC, TOPIC_PREFIX
from groundtrack.schemas import CLOSEST_RESPONSE, OVERLAP_ITEM, POSITION_FIELDS

MAX_ITEMS = 50       # items of a list message, about: some 9 KB of pairs
LAID = "_laid"       # a column by which rows are partitioned already, those of one key alike


def encode_positions(fixes: DataFrame, offset: str | None = None) -> DataFrame:
    """One message per fix on topic ``satellite-<sat_id>``, no key; null
    fields are sent as null, an id that is a plain integer as a number.
    ``offset`` names a column to pass through as the message offset."""
    body = F.to_json(F.struct(*POSITION_FIELDS), {"ignoreNullFields": "false"})
    extra = [F.col(offset).alias("offset")] if offset else []
    return fixes.select(
        F.concat(F.lit(TOPIC_PREFIX), F.col("sat_id")).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.regexp_replace(body, r'^\{"sat_id":"(0|[1-9][0-9]{0,17})"', r'{"sat_id":$1').alias("value"), *extra)


def encode_requests(reqs: DataFrame, stamp_now: bool = False) -> DataFrame:
    """Request messages. With ``stamp_now`` the timestamp is set when the
    message is encoded (server side), else the row's own is kept. Like the
    original client, null unprefixed coordinates are sent as well."""
    ts = F.unix_timestamp() if stamp_now else F.col("timestamp")
    body = F.struct(
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        "altitude", ts.alias("timestamp"), "choice_id", "obs_latitude", "obs_longitude")
    key = F.col("request_id").cast("string") if "request_id" in reqs.columns else F.lit(None).cast("string")
    return reqs.select(F.lit(REQUEST_TOPIC).alias("topic"), key.alias("key"),
                       F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def _single(df: DataFrame) -> DataFrame:
    return df.withColumns({"part": F.lit(0).cast("bigint"), "n_parts": F.lit(1).cast("bigint")})


def closest_response(closest: DataFrame) -> DataFrame:
    """One JSON object per answered request, keyed by request id."""
    body = F.struct(*[F.col(f.name) for f in CLOSEST_RESPONSE.fields])
    return _single(closest.select(F.lit(RESPONSE_TOPIC).alias("topic"),
                                  F.col("request_id").cast("string").alias("key"),
                                  F.to_json(body).alias("value")))


def overlap_response(pairs: DataFrame, max_items: int = MAX_ITEMS, key: str = "timestamp",
                     total: str | None = None) -> DataFrame:
    """Pairs as JSON list messages per ``key`` (an instant, or a request id
    when answering requests); items are sorted inside a message. ``total``
    names a column with the number of a key's pairs, where a caller knows it
    before they are built (``asof.overlap_answers``)."""
    item = F.struct(*[F.col(f.name) for f in OVERLAP_ITEM.fields])
    return _lists(pairs, key, RESPONSE_TOPIC, item, max_items, "sat_id1", "sat_id2", total=total)


def _lists(df: DataFrame, key: str, topic: str, item, max_items: int, *hash_cols: str,
           total: str | None = None) -> DataFrame:
    """List messages of about ``max_items`` items: a key's rows are dealt by a
    hash over as many messages as its count asks for, then numbered. Without
    ``total`` the rows are counted, and sorted to meet their count; with it
    they are shuffled once, or not at all where they are ``LAID`` out by key.
    Rows without a key are in no message."""
    if total is None:
        df, total = df.join(df.groupBy(key).agg(F.count(F.lit(1)).alias("_t")), key), "_t"
    else:
        df = df.where(F.col(key).isNotNull())
    laid = [c for c in (LAID,) if c in df.columns]
    n = F.ceil(F.col(total) / F.lit(max_items)).cast("bigint")
    dealt = df.select(*laid, key, F.pmod(F.xxhash64(*hash_cols), n).alias("_p"), item.alias("_i"))
    if total != "_t" and not laid:                       # both the lists and their numbers are per key
        dealt = dealt.repartition(key)
    g = dealt.groupBy(*laid, key, "_p").agg(F.sort_array(F.collect_list("_i")).alias("_l"))
    of_key = Window.partitionBy(*laid, key)              # one row a message
    return (g.withColumns({"part": (F.row_number().over(of_key.orderBy("_p")) - 1).cast("bigint"),
                           "n_parts": F.count(F.lit(1)).over(of_key)})
            .select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"),
                    *([key] if key != "key" else []), "part", "n_parts", F.to_json("_l").alias("value")))


def motion_request_response(answers: DataFrame, key: str = "request_id",
                            max_items: int = MAX_ITEMS) -> DataFrame:
    """Latest vector per object for each motion request, as JSON lists on
    the motion topic."""
    item = F.struct(
        "sat_id", "satname", "velocity_kmph",
        F.struct("delta_latitude", "delta_longitude").alias("direction"),
        F.col("vector_ts").alias("timestamp"))
    return _lists(answers, key, MOTION_TOPIC, item, max_items, "sat_id").select(
        "topic", "key", "part", "n_parts", "value")


def motion_response(top: DataFrame, batch: str = "batch") -> DataFrame:
    """The kept vectors of each batch as one JSON list (nested direction);
    a batch without vectors sends nothing."""
    item = F.struct(
        "sat_id", "satname", "velocity_kmph",
        F.struct("delta_latitude", "delta_longitude").alias("direction"), "timestamp")
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("timestamp").alias("_t"), F.col("seq").alias("_s"),
                                             item.alias("_i")))),
        lambda x: x["_i"])
    g = top.groupBy(batch).agg(ordered.alias("_l"))
    return _single(g.select(F.lit(MOTION_TOPIC).alias("topic"), F.col(batch).cast("string").alias("key"),
                            batch, F.to_json("_l").alias("value")))


def decode_responses(msgs: DataFrame, item_schema=CLOSEST_RESPONSE) -> DataFrame:
    """Response messages back to rows: a list gives one row per element, a
    single object one row (an object parsed as a list is wrapped). A message
    that holds no item stays as one row with a ``reject_reason``: ``empty``
    for ``[]``, ``unparseable`` for anything else, null values included."""
    keep = [c for c in msgs.columns if c != "value"]
    d = msgs.select(*keep, F.col("value").cast("string").alias("_v"),
                    F.from_json(F.col("value").cast("string"), ArrayType(item_schema)).alias("_a"))
    d = d.select(*keep, "_v", F.explode_outer("_a").alias("_r"))
    fields = [F.col(f"_r.{f.name}").alias(f.name) for f in item_schema.fields]
    nothing = reduce(and_, [F.col(f"_r.{f.name}").isNull() for f in item_schema.fields])
    reason = F.when(nothing, F.when(F.regexp_replace("_v", r"\s", "") == "[]", F.lit("empty")).otherwise(F.lit("unparseable")))
    return d.select(*keep, *fields, reason.alias("reject_reason"))


def whole_answers(msgs: DataFrame) -> DataFrame:
    """(topic, key, n_parts, whole): whether all parts of an answer are there."""
    return (msgs.groupBy("topic", "key").agg(F.max("n_parts").alias("n_parts"), F.count_distinct("part").alias("_got"))
            .select("topic", "key", "n_parts", (F.col("_got") == F.col("n_parts")).alias("whole")))
