"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples count as labels. Everything else, whatever its
label, is unlabelled text: a mixture of toxic documents (a share ``prior``) and
others. The risk of calling unlabelled text clean is corrected by that prior,

    prior * R(P, +) + max(0, R(U, -) - prior * R(P, -)),

and kept from falling below zero: where a mini-batch would push the corrected
part under zero, its gradient is turned round. The class prior is the share of
toxic rows among the training labels. The model is linear over hashed features:
whole words (log counts and rate) and word beginnings (rate), from whole texts.

Defined results: null and empty texts have no feature and get the model's
base score; without positive or unlabelled rows every score is the prior (0
without any); equal texts get equal scores; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.bytewords import ALNUM, Hasher, joined, lower_latin, mix64, runs
from groundtrack.llm.common import bounded_batches, bounded_sample, slices

BUCKETS = 1 << 16
#: Rows that the model is fitted on, at most: confirmed toxic, and unlabelled.
MAX_POSITIVE = 2000
MAX_UNLABELLED = 4000
#: Standard errors by which a feature must be more frequent in toxic text.
MIN_LIFT = 6.0
_SLICE = 1 << 20
_RATE, _START = 1, 2       # feature families behind the words


def featurize(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of several texts: row starts, feature ids, values."""
    data, begin = joined(texts)
    data = lower_latin(data)
    start, end = runs(ALNUM[data])
    if not len(start):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    row = np.searchsorted(begin, start, side="right") - 1
    n_words = np.bincount(row, minlength=len(texts))
    char = np.flatnonzero((data & 0xC0) != 0x80)                 # where code points begin
    first = np.searchsorted(char, start)
    char = np.append(char, np.full(6, len(data)))
    hasher, b = Hasher(data), np.uint64(BUCKETS)
    ids = [(hasher.spans(start, end) % b).astype(np.int64)]
    for n in (4, 6):
        head = hasher.spans(start, np.minimum(end, char[first + n])) + np.uint64(n)
        ids.append((mix64(head) % b).astype(np.int64) + BUCKETS)
    key, count = np.unique(np.tile(row, 3) * (2 * BUCKETS) + np.concatenate(ids), return_counts=True)
    row, fid = key // (2 * BUCKETS), key % (2 * BUCKETS)
    rate = np.minimum(2.0, 40.0 * count / np.maximum(n_words[row], 20.0))
    value = np.where(fid < BUCKETS, np.log1p(count), rate).astype(np.float32)
    word = fid < BUCKETS
    row = np.concatenate([row, row[word]])                       # words have a second column, their rate
    fid = np.concatenate([np.where(word, fid, fid - BUCKETS + _START * BUCKETS), fid[word] + _RATE * BUCKETS])
    value = np.concatenate([value, rate[word].astype(np.float32)])
    order = np.argsort(row, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]), fid[order], value[order]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, start: np.ndarray, fid: np.ndarray, value: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(start) - 1), np.diff(start))
        return np.bincount(row, self.weights[fid] * value, minlength=len(start) - 1) + self.bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(*featurize(texts)), -40, 40)))


def _take(start: np.ndarray, fid: np.ndarray, value: np.ndarray, rows: np.ndarray):
    n = np.diff(start)[rows]
    at = np.repeat(start[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return np.repeat(np.arange(len(rows)), n), fid[at], value[at]


def _groups(x: tuple[np.ndarray, np.ndarray, np.ndarray], size: int = 500):
    """The rows in groups: their numbers one entry a feature, ids and values."""
    start, fid, value = x
    for a in range(0, len(start) - 1, size):
        z = min(a + size, len(start) - 1)
        at = slice(start[a], start[z])
        yield np.repeat(np.arange(a, z), np.diff(start[a:z + 1])), fid[at], value[at].astype(np.float32)


def telling(x: tuple[np.ndarray, np.ndarray, np.ndarray], positive: np.ndarray, least: float = MIN_LIFT) -> np.ndarray:
    """Features more frequent among toxic rows than among unlabelled ones by
    ``least`` standard errors: others are noise of the hash and never get a weight."""
    n_p, n_u, size = positive.sum(), (~positive).sum(), 3 * BUCKETS
    total, seen, p, u = (np.zeros(size) for _ in range(4))
    for row, fid, value in _groups(x):
        other = ~positive[row]
        total += np.bincount(fid[other], value[other], minlength=size)
        seen += np.bincount(fid[other], minlength=size)
    mean = total / np.maximum(1, seen)                 # a rate counts as seen from half its mean in unlabelled text
    for row, fid, value in _groups(x):
        ok = value >= 0.5 * mean[fid]
        p += np.bincount(fid[ok & positive[row]], minlength=size) / n_p
        u += np.bincount(fid[ok & ~positive[row]], minlength=size) / n_u
    base = np.maximum(u, 1 / n_u)
    return np.flatnonzero((p - u) / np.sqrt(base * (1 - np.minimum(base, 0.9)) * (1 / n_p + 1 / n_u)) > least)


def fit_arrays(x: tuple[np.ndarray, np.ndarray, np.ndarray], positive: np.ndarray, prior: float, epochs: int = 40,
               decay: float = 1e-4, seed: int = 9) -> Model:
    """Non-negative PU risk with the logistic loss over the telling features, by
    Adam on mini-batches that hold both kinds of rows; the weights are the mean
    over the second half of the steps."""
    p_rows, u_rows = np.flatnonzero(positive), np.flatnonzero(~positive)
    q = min(max(prior, 1e-4), 1 - 1e-4)
    full = np.zeros(3 * BUCKETS, np.float32)
    use = telling(x, positive) if len(p_rows) and len(u_rows) else np.zeros(0, np.int64)
    if not len(use):
        return Model(full, float(np.log(q / (1 - q))))
    place = np.full(3 * BUCKETS, -1)
    place[use] = np.arange(len(use))
    kept = [(row[ok], place[fid[ok]], value[ok]) for row, fid, value in _groups(x) for ok in [place[fid] >= 0]]
    row, fid, value = (np.concatenate(c) for c in zip(*kept, strict=True))
    start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(positive)))])
    w, b = np.zeros(len(use)), float(np.log(q / (1 - q)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    mean_w, mean_b, taken = np.zeros_like(w), 0.0, 0
    rng, step, batches = np.random.default_rng(seed), 0, int(max(4, min(len(u_rows) // 500, len(p_rows) // 20)))
    epochs = max(epochs, 400 // batches)
    for epoch in range(epochs):
        lr = 0.05 * (1 - epoch / epochs) + 0.002
        for p, u in zip(np.array_split(rng.permutation(p_rows), batches), np.array_split(rng.permutation(u_rows), batches), strict=True):
            if not len(p) or not len(u):
                continue
            rows = np.concatenate([p, u])
            r, f, val = _take(start, fid, value, rows)
            z = np.bincount(r, w[f] * val, minlength=len(rows)) + b
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            is_p = np.arange(len(rows)) < len(p)
            minus = np.logaddexp(0, z)                                   # loss of calling a row clean
            corrected = minus[~is_p].mean() - prior * minus[is_p].mean()
            turn = 1.0 if corrected >= 0 else -1.0
            g = np.where(is_p, turn * -prior * s / len(p), turn * s / len(u))
            if turn > 0:
                g = g + np.where(is_p, prior * (s - 1) / len(p), 0.0)
            gw, gb, step = np.bincount(f, g[r] * val, minlength=len(w)) + decay * w, g.sum(), step + 1
            m = 0.9 * m + 0.1 * gw
            v = 0.999 * v + 0.001 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            w = w - lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
            b -= lr * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-6)
            if epoch >= epochs // 2:
                mean_w, mean_b, taken = mean_w + w, mean_b + b, taken + 1
    full[use] = mean_w / taken
    return Model(full, float(mean_b / taken))


def fit(df: DataFrame, positives: DataFrame, prior: float, text: str = "text", key: str = "doc_id",
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """``positives`` holds the keys of confirmed toxic rows; ``df`` the rows to
    learn from, all of which count as unlabelled too. Both are sampled by a
    hash of the key to about the given bounds."""
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    docs = df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter("k is not null")
    toxic = bounded_sample(positives.select(F.col(key).alias("k")).distinct(), "k", F.lit(1), max_positive)
    u = bounded_sample(docs.select("k"), "k", F.lit(0), max_unlabelled).distinct()
    chosen = toxic.withColumn("p", F.lit(True)).unionByName(u.withColumn("p", F.lit(False)))   # bounded by both limits

    def vectors(batches):
        for pdf in batches:
            for a, z in slices(pdf["t"].fillna("").str.len(), _SLICE):
                part = pdf.iloc[a:z]
                start, fid, value = featurize([t.encode("utf-8", "replace") for t in part["t"].fillna("")])
                yield pd.DataFrame({"k": part["k"].to_numpy(), "p": part["p"].to_numpy(),
                                    "f": [fid[i:j].astype(np.int32).tobytes() for i, j in zip(start[:-1], start[1:], strict=True)],
                                    "v": [value[i:j].astype(np.float16).tobytes() for i, j in zip(start[:-1], start[1:], strict=True)]})

    got = (docs.join(F.broadcast(chosen), "k")
           .mapInPandas(vectors, f"k {kind}, p boolean, f binary, v binary").toPandas())
    for c in ("f", "v"):
        got[c] = got[c].map(bytes)
    got = got.sort_values(["k", "p", "f"], kind="stable")
    count = got["f"].map(len).to_numpy(np.int64) // 4
    positive, f, v = got["p"].to_numpy(bool), b"".join(got["f"]), b"".join(got["v"])
    del got
    x = (np.concatenate([[0], np.cumsum(count)]), np.frombuffer(f, np.int32), np.frombuffer(v, np.float16))
    return fit_arrays(x, positive, prior)


def score(text: Column, model: Model, df: DataFrame) -> Column:
    """Probability that a text is toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        out, raw = np.zeros(len(texts)), [t.encode("utf-8", "replace") for t in texts.fillna("")]
        for a, z in slices(map(len, raw), _SLICE):
            out[a:z] = shared.value.score(raw[a:z])
        return pd.Series(out)

    return toxic(text)
