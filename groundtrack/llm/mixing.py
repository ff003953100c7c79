"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots, each one block of words of one source. Slot
``j`` takes the golden-ratio point ``frac(j * phi)`` and maps it through the
sources' cumulative shares of blocks, so that every stretch of the mix is close
to the target shares. A source's slots are ranked; rank ``r`` takes block
``r mod n`` of the source in pass ``r div n``, where the source's documents,
shuffled by a hash, are laid end to end and cut into ``n`` blocks of equal
words. The last slot of a source is cut so that its words are exactly the
rounded target; ranks past it are dropped, and the few that the points left
short follow at the end.

Targets: sources by code point, null last, weigh 5, 2, 1 and so on in turn;
none takes more than ``MAX_REPEAT`` times its own size; what is over is shared
anew by weight until none is above. Sizes, offsets and ranks are sums of sums:
per bucket of a source or chunk of slots first, then over the buckets, so no
task sees a whole source.

Defined results: a null or wordless text has size 0 and is never taken; an
empty table gives no rows; repeated rows and ids are rows of their own; a null
source is one source; reruns give the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundtrack.llm.common import WORD, saved

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Words per block, rows per shuffle bucket of a source, slots per chunk.
BLOCK, BUCKET_ROWS, CHUNK = 1024, 5000, 1 << 14
_GOLDEN = 0x9E3779B97F4A7C15          # frac(phi) in 64-bit fixed point


def sizes(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(rows: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """Per source: ``no`` (by code point, null last), weight, source_size,
    target and quota (the target in whole words).

    The capped sharing has a closed form: by rising cap per weight, the first
    sources reach their cap and the others share the rest by weight.
    """
    s = rows.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"), F.count("*").alias("n_rows"))
    every = Window.partitionBy(F.lit(0))          # one row a source
    by_name = every.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    s = s.withColumn("no", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("no") % len(WEIGHTS) + 1).cast("int")).cast("bigint"))
    s = s.withColumn("cap", F.col("source_size") * MAX_REPEAT)
    up = every.orderBy(F.col("cap") / F.col("weight"), "no")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("rest", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", F.col("rest") / F.col("open"))
         # the first source whose cap is not reached fixes the level for it and all after
         .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
         .withColumn("level", F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, 0))))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    return s.select("source", "no", "weight", "n_rows", "source_size", target.alias("target")).withColumn("quota", F.round("target").cast("bigint"))


def laid_out(rows: DataFrame, plan: DataFrame, key: str, seed: int = 0, size: str = "size", source: str = "source") -> DataFrame:
    """``rows`` with the source's ``no`` and the word offset ``at`` of each in
    its source's shuffled order."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    small = F.broadcast(plan.select(F.col("source").alias("__s"), "no", F.ceil(F.col("n_rows") / BUCKET_ROWS).alias("n_buckets")))   # one row a source
    r = (rows.join(small, F.col(source).eqNullSafe(F.col("__s"))).drop("__s").withColumn("__o", order)
         # buckets follow the order: the first hex digits, scaled
         .withColumn("__b", F.floor(F.conv(F.substring("__o", 1, 8), 16, 10).cast("bigint") * F.col("n_buckets") / F.lit(1 << 32))))
    inside = Window.partitionBy("no", "__b").orderBy("__o", F.col(size), F.col(key)).rowsBetween(Window.unboundedPreceding, -1)
    total = r.groupBy("no", "__b").agg(F.sum(size).alias("__n"))
    before = Window.partitionBy("no").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return (r.withColumn("__in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
            .join(total.select("no", "__b", "__before"), ["no", "__b"])
            .withColumn("at", F.col("__before") + F.col("__in")).drop("__b", "__o", "__in", "__before", "n_buckets"))


def _blocks(size: Column, block: int) -> Column:
    return F.ceil(size / block).cast("bigint")


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots of the mix: slot, no, rank, pass, block, and the words
    ``[lo, hi)`` of the source that it takes."""
    spark = plan.sparkSession
    s = [r for r in plan.orderBy("no").collect() if r["quota"] > 0]          # one small row a source
    if not s:
        return spark.createDataFrame([], "slot bigint, no int, rank bigint, pass bigint, block bigint, lo bigint, hi bigint")
    per = []
    for r in s:
        n = -(-r["source_size"] // block)
        whole, rest = divmod(r["quota"], r["source_size"])
        q, longer = divmod(r["source_size"], n)
        last = rest - 1                          # the last word of the last pass, and its block
        need = whole * n + (0 if not rest else 1 + (last // (q + 1) if last < longer * (q + 1) else longer + (last - longer * (q + 1)) // q))
        per.append((r["no"], r["source_size"], r["quota"], n, need))
    total = sum(p[4] for p in per)
    edges = np.cumsum([p[4] for p in per], dtype=np.float64) / total
    numbers = np.array([p[0] for p in per], np.int32)

    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c in pdf["chunk"]:
                j = np.arange(c * CHUNK, min(total, (c + 1) * CHUNK), dtype=np.uint64)
                u = ((j + np.uint64(1)) * np.uint64(_GOLDEN) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
                which = np.minimum(np.searchsorted(edges, u, side="right"), len(edges) - 1)
                order = np.argsort(which, kind="stable")
                first = np.searchsorted(which[order], which[order])
                rank = np.empty(len(j), np.int64)
                rank[order] = np.arange(len(j)) - first
                yield pd.DataFrame({"slot": j.astype(np.int64), "no": numbers[which], "chunk": c, "in_chunk": rank})

    chunks = spark.range(-(-total // CHUNK)).withColumnRenamed("id", "chunk")
    slots = chunks.mapInPandas(points, "slot bigint, no int, chunk bigint, in_chunk bigint")
    counts = slots.groupBy("no", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Spark takes what a Python function made to be as small as its input, and would broadcast it
    ranked = (slots.join(counts.select("no", "chunk", "before").hint("merge"), ["no", "chunk"])
              .select("slot", "no", (F.col("before") + F.col("in_chunk")).alias("rank")))
    per_source = spark.createDataFrame(per, "no int, source_size bigint, quota bigint, n_blocks bigint, need bigint")
    # sources that the points left short take their last ranks at the end
    short = (per_source.join(counts.groupBy("no").agg(F.sum("n").alias("got")), "no", "left")
             .withColumn("got", F.coalesce("got", F.lit(0))).filter("got < need")
             .select("no", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank"))
             .select((F.lit(total) + F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("rank", "no")) - 1).alias("slot"), "no", "rank"))
    return (ranked.unionByName(short).join(F.broadcast(per_source), "no").filter("rank < need")
            .withColumns({"pass": F.expr("rank div n_blocks"), "block": F.expr("rank % n_blocks")})
            .withColumns({"lo": F.expr(_EDGE.format(i="block")), "hi": F.expr(_EDGE.format(i="(block + 1)"))})
            .withColumn("hi", F.least("hi", F.expr("quota - pass * source_size")))
            .select("slot", "no", "rank", "pass", "block", "lo", "hi"))


#: First word of block i: the first ``size % n`` of n blocks have one word more.
_EDGE = "({i} * (source_size div n_blocks) + least({i}, source_size % n_blocks))"
#: Block of word w.
_BLOCK = ("(case when {w} < (source_size % n_blocks) * (source_size div n_blocks + 1) then {w} div (source_size div n_blocks + 1) "
          "else source_size % n_blocks + ({w} - (source_size % n_blocks) * (source_size div n_blocks + 1)) div (source_size div n_blocks) end)")


def pieces(laid: DataFrame, plan: DataFrame, slots: DataFrame, block: int = BLOCK, size: str = "size") -> DataFrame:
    """Per slot and row of ``laid`` the words taken: ``slot``, ``pass`` and the
    row's words ``[first, last)``, beside the row's columns."""
    per = F.broadcast(plan.select(F.col("no").alias("__no"), "source_size", _blocks(F.col("source_size"), block).alias("n_blocks")))
    inside = (laid.filter(F.col(size) > 0).join(per, F.col("no") == F.col("__no")).drop("__no")
              .withColumn("block", F.explode(F.sequence(F.expr(_BLOCK.format(w="at")), F.expr(_BLOCK.format(w=f"(at + {size} - 1)")))))
              .drop("source_size", "n_blocks"))
    return (inside.join(slots.hint("merge"), ["no", "block"])
            .withColumns({"first": F.greatest(F.lit(0).cast("bigint"), F.col("lo") - F.col("at")),
                          "last": F.least(F.col(size), F.col("hi") - F.col("at"))})
            .filter("first < last").drop("lo", "hi", "block", "rank"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, seed: int = 0
        ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of all rows: (plan per source, rows laid out, pieces taken)."""
    rows = saved(df.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), sizes(F.col(text)).alias("size")), "sizes")
    plan = saved(targets(rows), "targets")
    laid = saved(laid_out(rows, plan, "doc_id", seed), "laid-out")
    return plan, laid, pieces(laid, plan, schedule(plan, block), block)


def taken(plan: DataFrame, laid: DataFrame, parts: DataFrame) -> DataFrame:
    """Per row: size, source_size, target and the words that the mix takes."""
    got = (parts.groupBy(F.col("no").alias("__no"), F.col("at").alias("__at"), F.col("doc_id").alias("__id"))
           .agg(F.sum(F.col("last") - F.col("first")).alias("taken")))
    # offset and size tell the rows of a source apart: only wordless ones share an offset
    same = ((F.col("no") == F.col("__no")) & (F.col("at") == F.col("__at")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("size") > 0))
    return (laid.join(got, same, "left").join(F.broadcast(plan.select("no", "source_size", "target")), "no")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))
