"""Decoding and checking of incoming messages.

Raw records have ``value`` (JSON text or bytes) and ``topic``; a source
offset column, when present, becomes ``seq`` (ingest order). Parsing is
PERMISSIVE: text that is not JSON, or has none of the fields, gives an
all-null row; a field of the wrong type is null on its own. Rows that cannot
be used get a ``reject_reason`` instead of failing the job, so one bad
message never stops a stream; ``split`` separates them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.params import ACTIONS, TOPIC_PATTERN, UNKNOWN_ACTION, UNKNOWN_NAME, VALID_CHOICES
from groundtrack.schemas import API_DOC, POSITION, POSITION_FIELDS, REQUEST, REQUEST_FIELDS


def _text(c: str = "value") -> Column:
    return F.col(c).cast("string")


def topic_filter(raw: DataFrame, pattern: str = TOPIC_PATTERN) -> DataFrame:
    """Keep records of the per-object position topics."""
    return raw.where(F.col("topic").rlike(pattern))


def _position_reason() -> Column:
    f = [F.col(c) for c in POSITION_FIELDS]
    nothing = F.coalesce(*[c.cast("string") for c in f]).isNull()
    return (F.when(nothing, F.lit("unparseable"))
            .when(F.col("sat_id").isNull(), F.lit("missing_sat_id"))
            .when(F.col("latitude").isNull() | F.col("longitude").isNull(),
                  F.lit("missing_coordinates"))
            .when(F.col("timestamp").isNull(), F.lit("missing_timestamp")))


def parse_positions(raw: DataFrame, offset: str | None = "offset") -> DataFrame:
    """value/topic -> position columns + ``seq`` + ``reject_reason``.

    An integer ``sat_id`` in the JSON becomes its decimal string. Where the
    source names the topic's ``partition``, ``seq`` holds it above the offset,
    so equal offsets of two partitions stay apart.
    """
    keep = [F.col("topic")]
    if offset and offset in raw.columns:
        above = F.coalesce(F.col("partition").cast("bigint"), F.lit(0)) * F.lit(1 << 48) if "partition" in raw.columns else F.lit(0)
        keep.append((F.col(offset) + above).cast("bigint").alias("seq"))
    d = raw.select(*keep, F.from_json(_text(), POSITION).alias("_d"))
    d = d.select(*[c for c in d.columns if c != "_d"], *[F.col(f"_d.{c}").alias(c) for c in POSITION_FIELDS])
    return d.withColumn("reject_reason", _position_reason())


def parse_requests(raw: DataFrame, offset: str | None = "offset") -> DataFrame:
    """value -> request columns and ``request_id``: the source offset, or
    ``topic:partition:offset`` as text where the source names partitions (an
    offset alone is not unique then).

    Unknown keys (the null unprefixed ``latitude``/``longitude`` that the
    client always sends) are dropped by the schema.
    """
    has_id = bool(offset) and offset in raw.columns
    name = F.col(offset) if has_id else None
    if has_id and "partition" in raw.columns:
        name = F.when(F.col("partition").isNull(), F.col(offset).cast("string")).otherwise(
            F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col(offset).cast("string")))
    keep = [name.alias("request_id")] if has_id else []
    d = raw.select(*keep, F.from_json(_text(), REQUEST).alias("_d"))
    ids = ["request_id"] if has_id else []
    return d.select(*ids, *[F.col(f"_d.{c}").alias(c) for c in REQUEST_FIELDS])


def validate_requests(reqs: DataFrame) -> DataFrame:
    """Add ``reject_reason``: a choice outside 1..3, a closest-object request
    without a numeric observer location, or no time to answer as of."""
    c = F.col("choice_id")
    reason = (F.when(c.isNull(), F.lit("missing_choice"))
              .when(~c.isin(*VALID_CHOICES), F.lit("invalid_choice"))
              .when((c == 3) & (F.col("obs_latitude").isNull() | F.col("obs_longitude").isNull()),
                    F.lit("missing_location"))
              .when(F.col("timestamp").isNull(), F.lit("missing_timestamp")))
    return reqs.withColumn("reject_reason", reason)


def action_of(choice: Column) -> Column:
    out = F.lit(UNKNOWN_ACTION)
    for k in sorted(ACTIONS, reverse=True):
        out = F.when(choice == k, F.lit(ACTIONS[k])).otherwise(out)
    return out


def route_requests(reqs: DataFrame) -> DataFrame:
    """Add ``action``: 1 motion_vector, 2 overlap, 3 closest, 4 exit, else
    (null included) unknown. Every request is routed on its own."""
    return reqs.withColumn("action", action_of(F.col("choice_id")))


def route_counts(reqs: DataFrame) -> DataFrame:
    """Requests per action (partial counts per task, one tiny shuffle)."""
    return route_requests(reqs).groupBy("action").agg(F.count(F.lit(1)).alias("n_requests"))


def normalize_api(docs: DataFrame, id_col: str = "sat_id") -> DataFrame:
    """Positions API documents -> position rows.

    The first element of ``positions`` is the fix; ``info.satname`` or
    'Unknown' names it; ``satlatitude``/``satlongitude`` become
    ``latitude``/``longitude``. An empty or missing ``positions`` list gives
    ``reject_reason = 'no_positions'`` instead of an error.
    """
    d = docs.select(F.col(id_col).cast("string").alias("sat_id"),
                    F.from_json(_text(), API_DOC).alias("_d"))
    p = F.try_element_at(F.col("_d.positions"), F.lit(1))
    out = d.select(
        "sat_id",
        F.coalesce(F.col("_d.info.satname"), F.lit(UNKNOWN_NAME)).alias("satname"),
        p["satlatitude"].alias("latitude"), p["satlongitude"].alias("longitude"),
        p["azimuth"].alias("azimuth"), p["elevation"].alias("elevation"),
        p["timestamp"].alias("timestamp"),
        F.when(p.isNull(), F.lit("no_positions")).alias("reject_reason"))
    return out


def split(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reason column, rejected rows)."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())
