"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer numpy network with temperature-calibrated probabilities.

Random indexing gives every token a sparse random index vector (a few +1/-1,
drawn from its hash). A token's word vector is the sum of the index vectors of
its neighbours over the whole corpus, gathered in one pass: each task sums into
one fixed table (hashed vocabulary x dimensions), tables add up by a native
aggregate, and the result has the same size for any corpus. A document pools
its tokens: mean, deviation, and how concentrated and repetitive they are.

Two token kinds share the table: the word itself and its shape (case, digits,
punctuation, last letters), so that unseen words still have a vector.

Defined results: null and empty texts pool to zeros and get the network's
score for "no words"; with no or one-sided labels every score is the share of
label 1 (0.5 without labels); equal texts get equal scores; rows without a
label do not train; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.bytewords import ALNUM, DIGIT, SPACES, UPPER, Hasher, joined, lower_latin, mix64, runs
from groundtrack.llm.common import bounded_batches, bounded_sample, slices

VOCABULARY = 1 << 13      # hashed tokens
DIMENSIONS = 32           # of a word vector
NONZERO = 2               # entries of an index vector
HIDDEN = 32
DECAY = 2e-3
#: Labelled rows per label that the network is fitted on, at most.
TRAIN_PER_LABEL = 4000
CLIP = 4.0
_SLICE = 1 << 20
_EXTRA = 6


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of several texts: the text's number, the hashed word (lower
    case), and the hashed shape (case, digits, last four bytes with letters as
    one class)."""
    data, begin = joined(texts)
    start, end = runs(~SPACES[data])
    if not len(start):
        return start, start, start
    word = Hasher(lower_latin(data)).spans(start, end)
    letter = ALNUM[data] & ~DIGIT[data]
    tail = Hasher(np.where(letter, np.uint8(97), np.where(DIGIT[data], np.uint8(48), data))).spans(np.maximum(start, end - 4), end)
    upper, digits, letters = (np.concatenate([[0], np.cumsum(m)]) for m in (UPPER[data], DIGIT[data], letter))
    ups, n = upper[end] - upper[start], letters[end] - letters[start]
    case = np.where((n > 1) & (ups == n), 2, np.where(UPPER[data[start]], 1, 0)) * 2 + (digits[end] > digits[start])
    shape = mix64(tail + case.astype(np.uint64))
    v = np.uint64(VOCABULARY)
    return np.searchsorted(begin, start, side="right") - 1, (word % v).astype(np.int64), (shape % v).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of every token's index vector."""
    h = mix64(np.arange(VOCABULARY * NONZERO, dtype=np.uint64) + np.uint64(12345)).reshape(VOCABULARY, NONZERO)
    return (h % np.uint64(DIMENSIONS)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def context_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Word vectors of the hashed vocabulary from every whole text of ``df``:
    scaled to unit length, in a fixed table of ``VOCABULARY x DIMENSIONS``."""
    bounded_batches(df.sparkSession)

    def gather(batches):
        at, sign = index_vectors()
        table = np.zeros(VOCABULARY * DIMENSIONS)
        for pdf in batches:
            raw = [t.encode("utf-8", "replace") for t in pdf["t"].dropna()]
            for i, j in slices(map(len, raw), _SLICE):
                row, word, shape = tokens(raw[i:j])
                near = np.flatnonzero(row[1:] == row[:-1])            # neighbours of one text
                for centre, other in ((word[near], shape[near + 1]), (word[near + 1], shape[near]),
                                      (shape[near], word[near + 1]), (shape[near + 1], word[near])):
                    for k in range(NONZERO):
                        table += np.bincount(centre * DIMENSIONS + at[other, k], sign[other, k], minlength=len(table))
        table = table.reshape(VOCABULARY, DIMENSIONS)
        some = np.flatnonzero(np.abs(table).sum(1))
        out = pd.DataFrame(table[some], columns=[f"d{j}" for j in range(DIMENSIONS)])
        out.insert(0, "token", some)
        yield out

    cols = [f"d{j}" for j in range(DIMENSIONS)]
    got = (df.select(F.col(text).alias("t"))
           .mapInPandas(gather, "token long, " + ", ".join(f"{c} double" for c in cols))
           .groupBy("token").agg(*(F.sum(c).alias(c) for c in cols)).toPandas())   # VOCABULARY rows at most
    table = np.zeros((VOCABULARY, DIMENSIONS))
    if len(got):
        table[got["token"].to_numpy()] = np.round(got[cols].to_numpy(), 3)
    return (table / np.maximum(1e-9, np.sqrt((table**2).sum(1, keepdims=True)))).astype(np.float32)


def pool(texts: list[str], table: np.ndarray) -> np.ndarray:
    """One row per text: mean and deviation of its word and shape vectors,
    and how many, how varied and how concentrated its tokens are."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    row, *kinds = tokens(raw)
    n = np.bincount(row, minlength=len(raw)) if len(row) else np.zeros(len(raw), np.int64)
    some = np.flatnonzero(n)
    out = np.zeros((len(raw), 4 * DIMENSIONS + _EXTRA), np.float32)
    if not len(some):
        return out
    parts = []
    for ids in kinds:
        key, count = np.unique(row * VOCABULARY + ids, return_counts=True)
        owner, vectors = key // VOCABULARY, table[key % VOCABULARY]
        share = (count / n[owner]).astype(np.float32)[:, None]
        cut = np.searchsorted(owner, some)
        mean = np.add.reduceat(share * vectors, cut)
        parts += [mean, np.sqrt(np.maximum(0, np.add.reduceat(share * vectors * vectors, cut) - mean * mean)),
                  (np.bincount(owner, minlength=len(raw)) / n.clip(1))[some, None], np.add.reduceat(share * share, cut)]
    lines = [[x for x in raw[i].split(b"\n") if x.strip()] for i in some]
    parts.append(np.array([[np.log1p(k) / 10, 1 - len(set(x)) / max(1, len(x))] for k, x in zip(n[some], lines, strict=True)]))
    out[some] = np.concatenate(parts, axis=1)
    return out


def standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised inputs; odd documents stay within a few deviations."""
    return np.clip((x - centre) / scale, -CLIP, CLIP)


@dataclass(frozen=True)
class Network:
    table: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(standard(x, self.centre, self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows the network did not fit."""
    grid = np.exp(np.linspace(np.log(0.3), np.log(10), 60))
    soft = (y * len(y) + 1) / (len(y) + 2)           # one unseen row of either label: no certainty from few rows
    loss = [np.mean(soft * np.logaddexp(0, -logits / t) + (1 - soft) * np.logaddexp(0, logits / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_arrays(x: np.ndarray, y: np.ndarray, table: np.ndarray, epochs: int = 80, seed: int = 5) -> Network:
    """Train on four fifths, calibrate the temperature on the last fifth."""
    d = x.shape[1]
    if len(y) < 10 or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.02, 0.98)) if len(y) else 0.5
        return Network(table, np.zeros(d, np.float32), np.ones(d, np.float32), np.zeros((d, 1), np.float32), np.zeros(1, np.float32),
                       np.zeros(1, np.float32), float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, kept = order[: len(y) // 5], order[len(y) // 5:]
    centre, scale = x[kept].mean(0), x[kept].std(0) + 0.05
    z = standard(x, centre, scale)
    w = [rng.normal(0, d**-0.5, (d, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
         rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32), np.zeros(1, np.float32)]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(epochs):
        rng.shuffle(kept)
        lr = 0.01 * (1 - epoch / epochs)
        for s in range(0, len(kept), 128):
            i = kept[s:s + 128]
            h = np.tanh(z[i] @ w[0] + w[1])
            g = (1 / (1 + np.exp(-(h @ w[2] + w[3]))) - y[i]) / len(i)
            gh = np.outer(g, w[2]) * (1 - h * h)
            grads = [z[i].T @ gh + DECAY * w[0], gh.sum(0), h.T @ g + DECAY * w[2], np.array([g.sum()])]
            step += 1
            for k, gk in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                w[k] = (w[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    net = Network(table, centre, scale, w[0], w[1], w[2], float(w[3][0]), 1.0)
    return Network(table, centre, scale, w[0], w[1], w[2], float(w[3][0]), temperature_of(net.logits(x[held]), y[held]))


def fit(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "label",
        per_label: int = TRAIN_PER_LABEL, table: np.ndarray | None = None) -> Network:
    """Word vectors from every text of ``df``; the network from about
    ``per_label`` rows of each label in ``labels`` (key, label) at most."""
    bounded_batches(df.sparkSession)
    table = context_vectors(df, text) if table is None else table
    known = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
             .filter("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y")))
    sample = bounded_sample(known, "k", "y", per_label)
    b_table = df.sparkSession.sparkContext.broadcast(table)

    def vectors(batches):
        for pdf in batches:
            for i, j in slices(pdf["t"].fillna("").str.len(), _SLICE):
                part = pdf.iloc[i:j]
                x = pool(list(part["t"].fillna("")), b_table.value)
                yield pd.DataFrame({"k": part["k"].to_numpy(), "y": part["y"].to_numpy(), "x": [r.tobytes() for r in x]})

    kind = df.schema[key].dataType.simpleString()
    got = (df.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(sample), "k")   # bounded by per_label
           .mapInPandas(vectors, f"k {kind}, y int, x binary").toPandas())
    got["x"] = got["x"].map(bytes)
    got = got.sort_values(["k", "x"], kind="stable")
    x = np.stack([np.frombuffer(v, np.float32) for v in got["x"]]) if len(got) else np.zeros((0, 4 * DIMENSIONS + _EXTRA), np.float32)
    return fit_arrays(x, got["y"].to_numpy(np.float64), table)


def score(text: Column, net: Network, df: DataFrame) -> Column:
    """Probability of label 1 of a text column."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        filled = texts.fillna("")
        out = np.zeros(len(filled))
        for a, z in slices(filled.str.len(), _SLICE):
            out[a:z] = shared.value.score(pool(list(filled.iloc[a:z]), shared.value.table))
        return pd.Series(out)

    return quality(text)
