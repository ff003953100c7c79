"""Exact top-k inner products over vectors in descending length.

Vectors are scaled and floored to integers. Candidates are sorted by length
(Euclidean norm, descending) into blocks of ``BLOCK``; queries meet the blocks
in rounds, the longest vectors first, each round four times as many blocks as
the one before. After a round a query's k-th best score is its threshold: it
leaves as soon as its own length times the longest vector of the next block is
below that (Cauchy-Schwarz), and the others are packed into tiles with the
blocks that they can still need. Where a tile meets a block, vectors are turned
into the right singular vectors of a bounded sample, which gather most of an
inner product into its first axes. Partial sums over the leading axes plus the
product of the remaining lengths bound a score from above; pairs whose bound is
below the threshold are dropped, what is left is scored in integers. The
rotation decides only how early a pair is dropped, never the result.

Defined results: vectors that are null or hold a null or a non-finite component
and rows without an id take no part; a shorter vector counts as filled up with
zeros (an empty one scores 0 with all); equal rows (id and vector) count once,
an id with several vectors is as many queries and candidates, and never its own
candidate; ties go to the smaller id; fewer candidates than k give fewer rows.
Scores are 64-bit; products of lengths beyond 2**53 are summed in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches, saved

#: Vectors of a block, vectors of it that one matrix holds, and queries of a tile.
BLOCK, STRIP, TILE = 8192, 1024, 512
#: Vectors that the rotation is fitted on, at most.
SAMPLE = 4096
#: Shares of the axes after which a bound is taken.
CUTS = (1 / 8, 3 / 8)
#: Pairs of a strip that may be left for scoring one by one; beyond, all are scored as a matrix.
SPARSE = 0.05
_NONE = np.iinfo(np.int64).min
_EXACT = float(1 << 53)


def integers(vector: Column, scale: int) -> Column:
    """Floor of ``scale`` times each component; null if one is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(lists, d: int) -> np.ndarray:
    out = np.zeros((len(lists), d), np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def blocks(rows: DataFrame, d: int) -> DataFrame:
    """Candidates (id, v, norm) packed in blocks by descending length: part, seq,
    top (the greatest length in it), ids and vectors as bytes."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pd.DataFrame:
            pdf = pd.concat(held, ignore_index=True)
            return pd.DataFrame({"part": [part], "seq": [seq], "top": [float(pdf["norm"].max())], "n": [len(pdf)],
                                 "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "vectors": [_matrix(pdf["v"], d).tobytes()]})

        for pdf in batches:
            while len(pdf):
                take = pdf.iloc[:BLOCK - n]
                held.append(take)
                n, pdf = n + len(take), pdf.iloc[len(take):]
                if n == BLOCK:
                    yield block()
                    seq, held, n = seq + 1, [], 0
        if n:
            yield block()

    by_length = [F.col("norm").desc(), F.col("id")]
    return saved(rows.repartitionByRange(*by_length).sortWithinPartitions(*by_length)
                 .mapInPandas(pack, "part int, seq int, top double, n int, ids binary, vectors binary"), "blocks")


def rotation(rows: DataFrame, n: int, d: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, as columns, strongest first."""
    share = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 20)) < F.lit(min(1.0, SAMPLE / max(n, 1)) * (1 << 20))
    some = _matrix([r[0] for r in rows.filter(share).select("v").limit(SAMPLE).collect()], d).astype(float)
    if not len(some):
        return np.eye(d)
    return np.linalg.svd(some.T @ some)[2].T


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows."""
    most = np.sqrt((q.astype(float) ** 2).sum(1).max()) * np.sqrt((c.astype(float) ** 2).sum(1).max())
    return (q.astype(float) @ c.T.astype(float)).astype(np.int64) if most < _EXACT else q @ c.T


class _Turned:
    """Rotated vectors with what is left of their length behind each cut."""

    def __init__(self, v: np.ndarray, turn: np.ndarray, cuts: list[int]):
        self.at = v.astype(float) @ turn
        square = np.cumsum(self.at[:, ::-1] ** 2, 1)[:, ::-1]
        self.rest = {m: np.sqrt(square[:, m]) if m < self.at.shape[1] else np.zeros(len(v)) for m in cuts}
        self.norm = np.sqrt((self.at ** 2).sum(1))


def best_of(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, c_ids: np.ndarray, c: np.ndarray, turn: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of each query in a block, of those whose score is
    ``least`` or more; ``_NONE`` fills up."""
    d = q.shape[1]
    cuts = sorted({max(1, round(d * x)) for x in CUTS}) if d else []
    tq = _Turned(q, turn, cuts)
    best, ids, least = np.full((len(q), k), _NONE), np.full((len(q), k), np.iinfo(np.int64).max), least.copy()
    for a in range(0, len(c), STRIP):
        order = a + np.argsort(c_ids[a:a + STRIP], kind="stable")        # ties by id
        own, strip = c_ids[order], c[order]
        tc = _Turned(strip, turn, cuts)
        slack = 1e-9 * tq.norm[:, None] * tc.norm[None, :] + 1e-6
        floor = least.astype(float)[:, None] - slack
        alive, done, part = None, 0, 0.0
        for m in cuts:                        # partial sums over the leading axes
            if alive is None:
                part = tq.at[:, :m] @ tc.at[:, :m].T
                keep = part + tq.rest[m][:, None] * tc.rest[m][None, :] >= floor
                if keep.mean() <= SPARSE:
                    alive = np.nonzero(keep)
                    part = part[alive]
            else:
                i, j = alive
                part = part + (tq.at[i, done:m] * tc.at[j, done:m]).sum(1)
                keep = part + tq.rest[m][i] * tc.rest[m][j] >= floor[i, j]
                alive, part = (i[keep], j[keep]), part[keep]
            done = m
        score = np.full((len(q), len(order)), _NONE)
        if alive is None:
            score = _scores(q, strip)
        elif len(alive[0]):
            i, j = alive
            score[i, j] = (q[i] * strip[j]).sum(1)
        score[q_ids[:, None] == own[None, :]] = _NONE
        n = len(order)
        if np.abs(score[score != _NONE]).max(initial=0) < (1 << 62) // n:
            ranked = np.where(score == _NONE, _NONE, score * n + (n - 1 - np.arange(n)))
            top = np.argpartition(ranked, n - k, 1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), (len(q), n))
        else:
            top = np.lexsort((np.broadcast_to(own, score.shape), -score.astype(object)), axis=1)[:, :k]
        all_s = np.concatenate([best, np.take_along_axis(score, top, 1)], 1)
        all_i = np.concatenate([ids, own[top]], 1)
        order = np.lexsort((all_i, np.where(all_s == _NONE, np.iinfo(np.int64).max, -np.maximum(all_s, _NONE + 1))), axis=1)[:, :k]
        best, ids = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_i, order, 1)
        least = np.maximum(least, best[:, k - 1])
    return best, ids


def _meet(turn, d: int, k: int):
    """Rows of a tile beside a block: the best pairs of each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                q_ids, mark, least = (np.frombuffer(x, np.int64) for x in (r.q_ids, r.marks, r.least))
                best, ids = best_of(q_ids, np.frombuffer(r.q_vectors, np.int64).reshape(-1, d), least,
                                    np.frombuffer(r.ids, np.int64), np.frombuffer(r.vectors, np.int64).reshape(-1, d), turn.value, k)
                i, j = np.nonzero((best != _NONE) & (best >= least[:, None]))
                yield pd.DataFrame({"query_id": q_ids[i], "mark": mark[i], "vec_id": ids[i, j], "score": best[i, j]})
    return run


def _tiles(d: int, tops: np.ndarray, start: int, end: int):
    """Queries (id, mark, v, norm, least) packed in tiles with the blocks
    ``first`` .. ``last`` that one of them may need."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            least = pdf["least"].fillna(_NONE).to_numpy(np.int64)
            norm = np.maximum(pdf["norm"].to_numpy(float), 1e-300)
            need = np.where(least > 0, least.astype(float) * (1 - 1e-9) / norm, -1.0)     # length that a candidate must have
            order = np.argsort(need, kind="stable")
            for a in range(0, len(pdf), TILE):
                at = order[a:a + TILE]
                last = min(end, int(np.searchsorted(-tops, -need[at].min(), "right"))) - 1
                if last >= start:
                    yield pd.DataFrame({"first": [start], "last": [last], "q_ids": [pdf["id"].to_numpy(np.int64)[at].tobytes()],
                                        "marks": [pdf["mark"].to_numpy(np.int64)[at].tobytes()], "least": [least[at].tobytes()],
                                        "q_vectors": [_matrix(pdf["v"].iloc[at], d).tobytes()]})
    return run


def top_products(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5,
                 scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of each
    row that ``queries``, a condition on ``key``, holds for."""
    spark = df.sparkSession
    bounded_batches(spark)
    v = integers(F.col(vector), scale)
    rows = (df.select(F.col(key).cast("bigint").alias("id"), v.alias("v"), queries.alias("asks"))
            .filter("id is not null and v is not null").distinct())
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = saved(rows.withColumn("norm", F.sqrt(square)), "vectors")
    asked = rows.filter("asks").withColumn("mark", F.xxhash64("v")).drop("asks")
    d = rows.agg(F.max(F.size("v"))).first()[0] or 0
    packed = blocks(rows, d)
    index = packed.select("part", "seq", "top", "n").orderBy("part", "seq").collect()          # one row of numbers a block
    before = [(part, next(i for i, r in enumerate(index) if r["part"] == part)) for part in sorted({r["part"] for r in index})]
    empty = spark.createDataFrame([], "query_id bigint, mark bigint, vec_id bigint, score bigint, rank int")
    if not index:
        return empty.select("query_id", "rank", "vec_id", "score")
    packed = packed.join(F.broadcast(spark.createDataFrame(before, "part int, before int")), "part").withColumn("block", F.col("before") + F.col("seq"))
    tops = np.array([r["top"] for r in index])
    turn = spark.sparkContext.broadcast(rotation(rows, sum(r["n"] for r in index), d))
    by_score = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    state, start, size = empty, 0, 1
    while start < len(tops):
        end = min(len(tops), start + size)
        least = state.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "mark", F.col("score").alias("least"))
        open_ = asked.join(least, ["id", "mark"], "left").filter(
            F.col("least").isNull() | (F.col("norm") * float(tops[start]) * (1 + 1e-9) + 1e-6 >= F.col("least")))
        tiles = open_.mapInPandas(_tiles(d, tops, start, end), "first int, last int, q_ids binary, marks binary, least binary, q_vectors binary")
        pairs = (tiles.withColumn("block", F.explode(F.sequence("first", "last"))).drop("first", "last")
                 .join(packed.filter(F.col("block").between(start, end - 1)).select("block", "ids", "vectors"), "block"))
        found = pairs.mapInPandas(_meet(turn, d, k), "query_id bigint, mark bigint, vec_id bigint, score bigint")
        state = saved(state.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k), f"best-{end}")
        start, size = end, 4 * size
    return state.select("query_id", "rank", "vec_id", "score")
