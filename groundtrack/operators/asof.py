"""As-of lookup for requests, and the answers built on it.

``asof_join``: for every request and every object, the latest event (a fix,
a motion vector) with ``ts <= request.ts`` (latest by ``(ts, seq)``; an event
in the same second as the request counts). This is the "cache" a request
sees. It never expires; ``lookback_s`` bounds its age where wanted.

Plan (linear in fixes + answers, no range join and no nested loop):

* time is cut into buckets; only buckets that hold a request are looked at in
  detail, of all others only the last event per object is used;
* ``state``: each object's last event before each bucket with requests. With a
  look-back that is the bucket before; without one, the last events per bucket
  are carried on within epochs of many buckets, and the last events per epoch
  over the epochs, so no partition holds more than an epoch's buckets or an
  object's epochs;
* events of those buckets, the state and one copy per (object, *distinct
  request second*) are unioned and one window per (object, bucket), ordered
  by time, carries the last event forward onto each copy;
* requests pick up their rows by an equi-join on the request time (AQE's
  skew handling splits a hot second).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from groundtrack.functions import sphere
from groundtrack.functions.geo import haversine_km
from groundtrack.functions.ordering import order_key
from groundtrack.operators import overlap
from groundtrack.operators.codecs import LAID
from groundtrack.params import ASOF_BUCKET_S, COVERAGE_RADIUS_KM, EARTH_RADIUS_KM
from groundtrack.session import ensure_checkpoint_dir


#: What a position lookup carries of a fix.
POSITION_COLS = ("satname", "latitude", "longitude")
#: What a motion lookup carries of a vector.
VECTOR_COLS = ("satname", "velocity_kmph", "delta_latitude", "delta_longitude")


def asof_by_time(requests: DataFrame, events: DataFrame, value_cols: tuple[str, ...],
                 lookback_s: int | None = None, entity: str = "sat_id",
                 per_second: bool = False) -> DataFrame:
    """Rows (request time, entity, latest event as of that time), one per
    *distinct* ``requests.timestamp`` - what every request of that second
    sees. Output: request_ts, entity, value_cols, fix_ts, fix_seq.

    ``per_second`` first keeps only the last event of each (entity, second)
    - the only one an as-of lookup can return - with a partial aggregate.
    Then a window partition holds at most one event a second whatever
    the event rate of one entity (for feeds that may flood one object); it
    costs one more shuffle, so it is off by default.
    """
    width = int(lookback_s) if lookback_s else ASOF_BUCKET_S
    cols = ("timestamp", "seq", *value_cols)
    bucket = lambda c: F.floor(F.col(c) / F.lit(width)).cast("bigint")
    fx = events.select(F.col(entity).alias("_e"), *cols)
    # string values (names) go into grouping keys, so every aggregate buffer
    # is fixed-width and the aggregates below stay hash-based
    strings = [c for c in value_cols if isinstance(fx.schema[c].dataType, StringType)]
    if per_second:
        fx = (fx.withColumn("_k", order_key()).groupBy("_e", "timestamp", *strings)
              .agg(*[F.max_by(c, "_k").alias(c) for c in cols if c not in ("timestamp", *strings)]))
    fx = fx.where(F.col("timestamp").isNotNull()).withColumn("b", bucket("timestamp"))
    times = requests.select(F.col("timestamp").alias("t")).where(F.col("t").isNotNull()).distinct()
    times = times.withColumn("b", bucket("t"))
    wanted = times.select("b").distinct()

    ev_rows = fx.join(wanted, "b", "left_semi").select(
        "_e", "b", F.col("timestamp").alias("t"), F.lit(0).alias("kind"), F.struct(*cols).alias("fix"))
    # last event per (entity, bucket); should a name change inside a bucket
    # there are two, and the windows below still take the later one
    last = (fx.withColumn("_k", order_key()).groupBy("_e", "b", *strings)
            .agg(*[F.max_by(c, "_k").alias(c) for c in cols if c not in strings])
            .select("_e", "b", F.struct(*cols).alias("fix")))
    if lookback_s:
        tails = last.select("_e", (F.col("b") + 1).alias("b"), "fix")
        presence = fx.select("_e", F.explode(F.array("b", F.col("b") + 1)).alias("b")).distinct()
    else:
        tails = presence = _state_before(last, wanted)
        presence = presence.select("_e", "b")
        tails = tails.where(F.col("fix").isNotNull())
    tails = tails.select("_e", "b", F.col("fix.timestamp").alias("t"), F.lit(0).alias("kind"), "fix")

    # the window sees each distinct request time once (at most one a second per
    # bucket), not every request: a burst of requests in one second cannot
    # overload a partition; requests get their rows by an equi-join on time
    copies = (times.join(presence, "b")
              .select("_e", "b", "t", F.lit(1).alias("kind"),
                      F.lit(None).cast(ev_rows.schema["fix"].dataType).alias("fix")))

    rows = ev_rows.unionByName(tails).unionByName(copies)
    w = (Window.partitionBy("_e", "b").orderBy("t", "kind", F.col("fix.seq"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = rows.withColumn("_last", F.last("fix", ignorenulls=True).over(w))
    seen = (F.col("kind") == 1) & F.col("_last").isNotNull()
    if lookback_s:
        seen = seen & (F.col("_last.timestamp") >= F.col("t") - F.lit(width))
    return (carried.where(seen)
            .select(F.col("t").alias("request_ts"), F.col("_e").alias(entity),
                    *[F.col(f"_last.{c}").alias(c) for c in value_cols],
                    F.col("_last.timestamp").alias("fix_ts"), F.col("_last.seq").alias("fix_seq")))


EPOCH_BUCKETS = 512         # buckets of an epoch when states are carried on


def _state_before(last: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_e, b, fix): the last event before each wanted bucket of every entity
    that may have one (null fix: none yet). ``last`` has the last event of
    each (entity, bucket)."""
    epoch = F.floor(F.col("b") / EPOCH_BUCKETS).cast("bigint")
    names = last.schema["fix"].dataType.names
    strings = [f.name for f in last.schema["fix"].dataType.fields if isinstance(f.dataType, StringType)]
    last, wanted = last.withColumn("p", epoch), wanted.withColumn("p", epoch)
    epochs = wanted.select("p").distinct()
    # every wanted epoch from the entity's first one on
    first = last.groupBy("_e").agg(F.min("p").alias("f"))
    top = epochs.agg(F.max("p")).scalar()
    need = (first.where(F.col("f") <= top).select("_e", F.explode(F.sequence(F.col("f"), top)).alias("p"))
            .join(epochs, "p"))
    flat = last.select("_e", "p", "fix.*").withColumn("_k", order_key())
    ends = (flat.groupBy("_e", "p", *strings).agg(*[F.max_by(c, "_k").alias(c) for c in names if c not in strings])
            .select("_e", "p", F.struct(*names).alias("fix")))
    nothing = F.lit(None).cast(last.schema["fix"].dataType)

    def carried(rows: DataFrame, keys: list, order: str) -> DataFrame:
        w = (Window.partitionBy(*keys).orderBy(order, "kind", F.col("fix.timestamp"), F.col("fix.seq"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return rows.withColumn("state", F.last("fix", ignorenulls=True).over(w)).where("kind = 0")

    starts = carried(need.select("_e", "p", F.lit(0).alias("kind"), nothing.alias("fix"))
                     .unionByName(ends.select("_e", "p", F.lit(1).alias("kind"), "fix")), ["_e"], "p")
    lowest = F.lit(-(1 << 62)).cast("bigint")
    inside = (need.join(wanted, "p").select("_e", "p", "b", F.lit(0).alias("kind"), nothing.alias("fix"))
              .unionByName(starts.where(F.col("state").isNotNull()).select("_e", "p", lowest.alias("b"), F.lit(1).alias("kind"),
                                                                          F.col("state").alias("fix")))
              .unionByName(last.join(epochs, "p", "left_semi").select("_e", "p", "b", F.lit(1).alias("kind"), "fix")))
    return carried(inside, ["_e", "p"], "b").select("_e", "b", F.col("state").alias("fix"))


def asof_join(requests: DataFrame, events: DataFrame, value_cols: tuple[str, ...],
              lookback_s: int | None = None,
              request_cols: tuple[str, ...] = ("obs_latitude", "obs_longitude"),
              key: str = "request_id", entity: str = "sat_id",
              per_second: bool = False) -> DataFrame:
    """Rows (request, entity, latest event as of the request time).

    ``events`` need ``entity``, ``timestamp``, ``seq`` and ``value_cols``;
    the event chosen per (request, entity) is the greatest ``(timestamp,
    seq)`` with ``timestamp <= request.ts``, and not older than ``lookback_s``
    where that is given.
    Output: key, request_ts, request_cols, entity, value_cols, fix_ts, fix_seq.
    The lookup runs once per distinct request time (``asof_by_time``) and
    requests pick up their rows by an equi-join on the time.
    """
    hit = asof_by_time(requests, events, value_cols, lookback_s, entity, per_second)
    rq = requests.select(key, F.col("timestamp").alias("request_ts"), *request_cols)
    return rq.join(hit, "request_ts").select(
        key, "request_ts", *request_cols, entity, *value_cols, "fix_ts", "fix_seq")


def asof_positions(requests: DataFrame, fixes: DataFrame,
                   lookback_s: int | None = None,
                   request_cols: tuple[str, ...] = ("obs_latitude", "obs_longitude"),
                   key: str = "request_id") -> DataFrame:
    """Rows (request, object, latest fix as of the request time)."""
    return asof_join(requests, fixes, POSITION_COLS, lookback_s,
                     request_cols, key)


_BEST = ("_d", "sat_id", "satname", "latitude", "longitude", "obs_latitude", "obs_longitude",
         "request_ts", "fix_ts")


def _nearest(cand: DataFrame, key: str) -> DataFrame:
    """Arg-min of ``_d`` per request (ties: lowest ``sat_id``). Grouped by
    (request time, request): the same groups, since a request has one time,
    and candidates joined on the request time are already partitioned by it,
    so no further shuffle is needed."""
    return (cand.where(F.col("_d").isNotNull())
            .groupBy("request_ts", key).agg(F.min(F.struct(*_BEST)).alias("m")))


#: Objects expected near a request in the first round of the closest-object search.
NEAR = 4
#: So many objects at most are compared with a request directly.
DIRECT = 32
#: Times that the cells of a round are as wide as those of the one before.
WIDER = 4


def closest_satellite(requests: DataFrame, fixes: DataFrame,
                      lookback_s: int | None = None, key: str = "request_id",
                      digits: int | None = 2, cell_deg: float | None = None,
                      seen: DataFrame | None = None) -> DataFrame:
    """Per request, the object whose as-of fix is nearest to the observer.

    Ties go to the lowest ``sat_id``; fixes without coordinates are never
    candidates; a request that sees no fix gets no row. The
    arg-min is ``min(struct(distance, sat_id, ...))`` grouped by request,
    aggregated partially before its shuffle.

    Objects are found through cells on the unit sphere, in rounds (see
    ``_closest_by_cells``). ``cell_deg`` is the width of the first cells in
    degrees of arc; without it they are as wide as about ``NEAR`` objects need
    (their approximate number is counted, one aggregate over the ids). Results
    do not depend on it.

    ``seen`` are stored as-of rows (``POSITION_COLS`` of ``asof_by_time``) of the
    request times, or of more times, where a caller has them already.
    """
    a = asof_by_time(requests, fixes, POSITION_COLS, lookback_s) if seen is None else seen
    a = a.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    rq = requests.select(key, F.col("timestamp").alias("request_ts"), "obs_latitude", "obs_longitude")
    if cell_deg is not None:
        if cell_deg <= 0:
            raise ValueError("cell_deg must be positive")
        width = sphere.chord(math.radians(cell_deg))
    else:
        n = fixes.agg(F.approx_count_distinct("sat_id")).first()[0]
        width = 2 * math.sqrt(NEAR / n) if n > DIRECT else 2.0           # a cap of this radius is NEAR / n of the sphere
    if width < 2 and seen is None:                        # every round reads them: made once, in the shared folder
        ensure_checkpoint_dir(requests.sparkSession)
        a = a.checkpoint()
    best = _closest_by_cells(rq, a, key, width)
    dist = F.round("m._d", digits) if digits is not None else F.col("m._d")
    return best.select(
        key, F.col("m.satname").alias("satname"), F.col("m.sat_id").alias("sat_id"),
        F.col("m.latitude").alias("latitude"), F.col("m.longitude").alias("longitude"),
        dist.alias("distance_km"),
        F.col("m.obs_latitude").alias("observer_lat"), F.col("m.obs_longitude").alias("observer_lon"),
        F.col("m.request_ts").alias("timestamp"), F.col("m.fix_ts").alias("fix_ts"))


def _with_distance(c: DataFrame) -> DataFrame:
    return c.withColumn("_d", haversine_km("obs_latitude", "obs_longitude", "latitude", "longitude"))


def _candidates(rest: DataFrame, objects: DataFrame, width: float) -> DataFrame:
    """Requests beside the objects of their own cell and its neighbours, by an
    equi-join on (time, cell); with cells as wide as the sphere, beside all."""
    if width >= 2:
        return rest.join(objects.hint("merge"), "request_ts")
    near = sphere.copied_to_block(rest, "r_", width)
    return near.join(objects.withColumns(sphere.cells("o_", width)).hint("merge"), ["request_ts", "c_x", "c_y", "c_z"])


def _closest_by_cells(rq: DataFrame, a: DataFrame, key: str, width: float) -> DataFrame:
    """Exact nearest object by expanding cells.

    Requests and objects are directions on the unit sphere, in cubic cells of
    ``width``. A request first meets the objects of its own cell and the 26
    around it. Everything outside is further away than the nearest side of that
    block (``clearance``), so a nearest candidate within it is the true nearest,
    at the poles and the antimeridian as anywhere. Only requests that are not
    certified so go on, to cells ``WIDER`` times as wide, up to one that holds
    the whole sphere. What a round settles and what it leaves is written to the
    shared folder, so that each plan holds one round whatever their number.

    All joins are sort-merge joins: both sides grow with the requests, and by
    their estimated sizes (of compressed files, copies to cells not counted) Spark
    would broadcast them.
    """
    rest = rq.select("*", *sphere.unit_vector("obs_latitude", "obs_longitude", "r_"))
    if width < 2:
        ensure_checkpoint_dir(rq.sparkSession)
        rest = rest.checkpoint()
    objects = a.select("*", *sphere.unit_vector("latitude", "longitude", "o_"))
    best = None
    while True:
        found = _nearest(_with_distance(_candidates(rest, objects, width)), key)
        if width >= 2:
            return found if best is None else best.unionByName(found)
        sure = (found.join(rest.select(key, sphere.clearance("r_", width).alias("_g")).hint("merge"), key)
                .where(sphere.chord_of(F.col("m._d") / F.lit(EARTH_RADIUS_KM)) < F.col("_g") * (1 - 1e-9) - 1e-9)
                .select("request_ts", key, "m")).checkpoint()
        best = sure if best is None else best.unionByName(sure)
        rest = rest.join(sure.select(key).hint("merge"), key, "left_anti").checkpoint()
        width *= WIDER


def motion_answers(requests: DataFrame, vectors: DataFrame,
                   lookback_s: int | None = None, key: str = "request_id") -> DataFrame:
    """A motion request is answered with the latest vector of every object
    as of the request time; computed once
    per distinct request time."""
    a = asof_join(requests, vectors, VECTOR_COLS, lookback_s, (), key)
    return a.select(key, F.col("request_ts").alias("timestamp"), "sat_id", "satname", "velocity_kmph",
                    "delta_latitude", "delta_longitude", F.col("fix_ts").alias("vector_ts"))


def satellites_in_view(requests: DataFrame, fixes: DataFrame, required: int,
                       lookback_s: int | None = None, key: str = "request_id") -> DataFrame:
    """Completeness gate per request: how many objects its as-of cache holds
    and whether that equals ``required``. Counted once per distinct request
    time, then joined to the requests (a request with an empty cache has
    no row)."""
    n = (asof_by_time(requests, fixes, (), lookback_s)
         .groupBy("request_ts").agg(F.count_distinct("sat_id").alias("n_satellites")))
    rq = requests.select(key, F.col("timestamp").alias("request_ts"))
    return rq.join(n, "request_ts").select(
        key, "n_satellites", (F.col("n_satellites") == F.lit(required)).alias("complete"))


#: Pairs that a task builds and sorts into messages, about (some 250 bytes each).
PAIRS_A_TASK = 500_000


def overlap_answers(requests: DataFrame, fixes: DataFrame, lookback_s: int | None = None,
                    radius_km: float = COVERAGE_RADIUS_KM, required_satellites: int | None = None,
                    key: str = "request_id", seen: DataFrame | None = None,
                    total: str | None = None) -> DataFrame:
    """An overlap request is answered with the coverage overlap of the
    objects in its as-of cache, pairing fixes of equal timestamp (as the
    original does); with ``required_satellites`` only a cache holding
    exactly that many objects is answered.

    The cache depends only on the request time and is looked up once for each.
    Requests take their objects before the pairs are built - the join key is
    (time, request, fix time), a group never exceeds the object count - since an
    answer has far more pairs than objects, and a join of pairs with requests
    would shuffle and sort them all. ``seen``: stored as-of rows, as in
    ``closest_satellite``. ``total`` names a column to add: how many pairs the
    answers under the row's ``key`` have together, counted from the objects. With
    it the objects are dealt by request first, over as many tasks as the pairs
    ask for, and the pairs stay where they are built: all pairs of a ``key`` are
    in one partition, by the column ``codecs.LAID`` (``codecs.overlap_response``
    then shuffles nothing).
    """
    rq = requests.select(key, F.col("timestamp").alias("request_ts"))
    a = (asof_by_time(requests, fixes, POSITION_COLS, lookback_s) if seen is None
         else seen.join(rq.select("request_ts"), "request_ts", "left_semi"))
    if required_satellites is not None:
        n = a.groupBy("request_ts").agg(F.count_distinct("sat_id").alias("_n"))
        a = a.join(n.where(F.col("_n") == required_satellites).select("request_ts"), "request_ts", "left_semi")
    laid = []
    if total is not None:
        counts = _pairs_of_key(rq, a, key, total)
        n_pairs = counts.agg(F.sum(total)).first()[0] or 0
        rq = rq.join(counts, key, "left")
        # rows without a key are in no message, and need not meet
        laid = [F.xxhash64(key, F.when(F.col(key).isNull(), F.col("request_ts"))).alias(LAID)]
    # requests alike in id and time are answered each: numbered, and a null id is an id
    asked = (rq.groupBy(*rq.columns).count().withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count"))))
             .select("request_ts", F.struct(*[c for c in rq.columns if c != "request_ts"], "_i").alias("_q"), *laid))
    if total is None:
        pairs = overlap.pairs(asked.join(a, "request_ts"), ["request_ts", "_q", "fix_ts"], radius_km, time_col="fix_ts",
                              keep=("_q",), hint=None)
        return pairs.select(F.col(f"_q.{key}").alias(key), *[c for c in pairs.columns if c != "_q"])
    tasks = max(requests.sparkSession.sparkContext.defaultParallelism, math.ceil(n_pairs / PAIRS_A_TASK))
    points = asked.join(a.hint("merge"), "request_ts").repartition(tasks, LAID)
    pairs = overlap.pairs(points, [LAID, "request_ts", "_q", "fix_ts"], radius_km, time_col="fix_ts", keep=("_q", LAID), gather=True)
    return pairs.select(F.col(f"_q.{key}").alias(key), *[c for c in pairs.columns if c != "_q"], F.col(f"_q.{total}").alias(total))


def _pairs_of_key(rq: DataFrame, a: DataFrame, key: str, total: str) -> DataFrame:
    """(key, total): the number of pairs in the answers of all requests of a
    key. Of objects at one fix time all but those with the same id pair up."""
    alike = (a.where(F.col("sat_id").isNotNull()).groupBy("request_ts", "fix_ts", "sat_id")
             .agg(F.count(F.lit(1)).alias("_c")))
    n = F.expr("(sum(_c) * sum(_c) - sum(_c * _c)) div 2")
    per_time = (alike.groupBy("request_ts", "fix_ts").agg(n.alias("_n"))
                .groupBy("request_ts").agg(F.sum("_n").alias("_n")))
    return rq.join(per_time, "request_ts").groupBy(key).agg(F.sum("_n").alias(total))
