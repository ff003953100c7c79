"""Connected components of an edge table, by forests of its parts and alternating stars.

Each round first contracts bounded parts of the edges: what a part connects
becomes a star around its least vertex (``star_forest``), without a shuffle.
Edges that fit one part are done then. Others are rewired to a smaller neighbour
(large star, then small star) until only stars are left; the smallest vertex of
a component ends as the centre of its star. Rounds are written to the shared
folder, edges never leave Spark, and a vertex with many edges is aggregated
before it is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.common import saved

#: Edges that a task contracts at once.
EDGES = 250_000


def star_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (vertex, least vertex of its component) that connect what (u, v) connect."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(ids))
    while (label[a] != label[b]).any():
        np.minimum.at(label, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
        while (label[label] != label).any():
            label = label[label]
    low = np.flatnonzero(label != np.arange(len(ids)))
    return ids[low], ids[label[low]]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def stars() -> pd.DataFrame:
        u, v = star_forest(*(np.concatenate([pdf[c].to_numpy() for pdf in held]) for c in "uv"))
        return pd.DataFrame({"u": u, "v": v})

    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n > EDGES:
            yield stars()
            held, n = [], 0
    if n:
        yield stars()


def _lowest(edges: DataFrame) -> DataFrame:
    """Per vertex ``u`` its least neighbour, itself included."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _all_stars(edges: DataFrame) -> bool:
    """Whether no vertex of distinct ``edges`` has two smaller neighbours, or one and a larger one."""
    ends = (edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(v, component): the smallest vertex reachable, for every vertex that has
    an edge. ``edges`` has two long columns ``u`` and ``v``; nulls and loops
    are ignored."""
    e = saved(edges.filter("u is not null and v is not null and u != v").select("u", "v")
              .mapInPandas(_contract, "u bigint, v bigint"), "edges")
    while True:
        tasks = max(1, -(-e.count() // EDGES))
        e = saved(e.coalesce(tasks).mapInPandas(_contract, "u bigint, v bigint"), "forests")
        if tasks == 1:                                    # one forest
            break
        # large star: each larger neighbour of u points to u's least neighbour
        both = _both(e)
        large = (both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = saved(large.distinct(), "large")
        # small star: u and its smaller neighbours point to the least of them
        low = _lowest(e)
        small = (e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v"))
        e = saved(small.distinct(), "small")
        if _all_stars(e):
            break
    return e.select(F.col("u").alias("v"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v"), F.col("v").alias("component")).distinct())
