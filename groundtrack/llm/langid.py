"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. One binary classifier per bit, a
logistic model over hashed byte n-grams, predicts that bit; the language whose
codeword costs the least total logistic loss wins (loss-weighted decoding).
When the second codeword costs nearly as little, the row is flagged ambiguous.

Up to seven languages take the exhaustive code (all two-way splits); more take
a dense random code, the one of several drawn whose closest rows differ most.

Defined results: a null text or one without a letter is ``und`` with score 0;
with no training row every text is ``und``; rows without a language do not
train; equal texts get equal results; extra columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches, bounded_sample, slices

#: Hashed n-gram buckets, and the n-gram lengths in bytes of lower-cased UTF-8.
BUCKETS = 4096
GRAMS = (1, 2, 3, 4)
#: Training rows per language at most (a classifier may be fitted on a bounded sample).
TRAIN_PER_LANGUAGE = 1000
#: A margin below this, in loss per bit between the two best codewords, is ambiguous.
AMBIGUOUS = 0.05
_SLICE = 1 << 20


def codebook(k: int, seed: int = 11) -> np.ndarray:
    """Codewords of ``k`` classes, one row of -1/+1 each."""
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 7:
        bits = 2 ** (k - 1) - 1
        cols = np.arange(1, bits + 1)
        rows = [np.zeros(bits, int)] + [(cols >> i) & 1 for i in range(k - 1)]
        return np.where(np.array(rows) > 0, 1, -1).astype(np.int8)
    bits, rng = int(np.ceil(10 * np.log2(k))), np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), size=(k, bits))
        agree = code.astype(int) @ code.T.astype(int)
        np.fill_diagonal(agree, -bits)
        least = (bits - agree.max()) // 2
        if least > far and not (np.abs(code.sum(0)) == k).any():
            best, far = code, least
    return best


def gram_counts(texts: list[str], buckets: int = BUCKETS, grams: tuple[int, ...] = GRAMS) -> np.ndarray:
    """Rows of n-gram frequencies: square roots of shares, each row of length 1."""
    out = np.zeros((len(texts), buckets), np.float32)
    for r, t in enumerate(texts):
        b = np.frombuffer((" " + t.lower() + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
        h = np.zeros(len(b), np.uint32)
        row = np.zeros(buckets, np.int64)
        for n in range(1, max(grams) + 1):
            if len(b) < n:
                break
            h = (h[: len(b) - n + 1] * np.uint32(0x01000193)) ^ (b[n - 1:] + np.uint32(n << 9))
            if n in grams:
                row += np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(np.log2(buckets))), minlength=buckets)
        out[r] = np.sqrt(row / max(1, row.sum()))
    return out


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, and weights (buckets x bits) with biases."""

    langs: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    buckets: int = BUCKETS

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language index, its share of the softened losses, ambiguity."""
        margin = x @ self.weights + self.bias
        loss = np.stack([np.logaddexp(0.0, -margin * c).mean(1) for c in self.code.astype(np.float32)], axis=1)
        best = loss.argmin(1)
        p = np.exp(-(loss - loss.min(1, keepdims=True)) * self.code.shape[1])
        score = 1.0 / p.sum(1)
        if loss.shape[1] == 1:
            return best, score, np.zeros(len(best), bool)
        two = np.partition(loss, 1, axis=1)
        return best, score, (two[:, 1] - two[:, 0]) < AMBIGUOUS


def fit_arrays(x: np.ndarray, y: np.ndarray, langs: tuple[str, ...], epochs: int = 60, rate: float = 0.5,
               decay: float = 1e-5, seed: int = 3) -> Model:
    """Fit one logistic classifier per code bit, all bits at once, by Adam over
    shuffled mini-batches; classes weigh alike however many rows they have."""
    code = codebook(len(langs))
    target = (code[y] > 0).astype(np.float32)
    weight = (len(y) / (len(langs) * np.bincount(y, minlength=len(langs)).clip(1)))[y].astype(np.float32)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for s in range(0, len(y), 256):
            i = order[s:s + 256]
            g = (1 / (1 + np.exp(-(x[i] @ w + b))) - target[i]) * weight[i, None] / len(i)
            gw, gb, step = x[i].T @ g + decay * w, g.sum(0), step + 1
            for p, m, v, d in ((w, mw, vw, gw), (b, mb, vb, gb)):
                m *= 0.9
                m += 0.1 * d
                v *= 0.999
                v += 0.001 * d * d
                p -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(langs, code, w, b, x.shape[1])


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = TRAIN_PER_LANGUAGE, buckets: int = BUCKETS) -> Model:
    """Learn from rows with a text and a language: about ``per_language`` rows of
    each language at most, taken by a hash of the key. Their n-gram rows
    (half-precision) come to the driver, which bounds what it holds."""
    bounded_batches(df.sparkSession)
    rows = (df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
            .filter(F.col("t").isNotNull() & F.col("l").isNotNull()))

    def vectors(batches):
        for pdf in batches:
            for a, z in slices(pdf["t"].str.len(), _SLICE):
                part = pdf.iloc[a:z]
                x = gram_counts(list(part["t"]), buckets).astype(np.float16)
                yield pd.DataFrame({"k": part["k"].to_numpy(), "l": part["l"].to_numpy(), "x": [r.tobytes() for r in x]})

    got = (bounded_sample(rows, "k", "l", per_language)
           .mapInPandas(vectors, f"k {rows.schema['k'].dataType.simpleString()}, l string, x binary").toPandas())
    got = got.sort_values(["l", "k"], kind="stable", na_position="first").reset_index(drop=True)
    langs = tuple(sorted(got["l"].unique()))
    if not langs:
        return Model((), np.ones((0, 1), np.int8), np.zeros((buckets, 1), np.float32), np.zeros(1, np.float32), buckets)
    x = np.stack([np.frombuffer(bytes(v), np.float16) for v in got["x"]]).astype(np.float32)
    return fit_arrays(x, got["l"].map({v: i for i, v in enumerate(langs)}).to_numpy(), langs)


def predict(text: Column, model: Model) -> Column:
    """Struct (lang_pred, score, ambiguous) of a text column."""
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def identify(texts: pd.Series) -> pd.DataFrame:
        filled = texts.fillna("")
        letters = np.array([any(map(str.isalpha, t)) for t in filled], bool)
        pred = np.full(len(filled), "und", object)
        score, unsure = np.zeros(len(filled)), np.zeros(len(filled), bool)
        rows = np.flatnonzero(letters) if model.langs else np.array([], int)
        for a, z in slices((len(filled.iloc[i]) + model.buckets for i in rows), _SLICE):
            i = rows[a:z]
            best, s, u = model.decode(gram_counts([filled.iloc[j] for j in i], model.buckets))
            pred[i], score[i], unsure[i] = np.array(model.langs, object)[best], s, u
        return pd.DataFrame({"lang_pred": pred, "score": score.clip(0, 1), "ambiguous": unsure})

    return identify(text)


def identify_language(df: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``ambiguous`` (prefixed) added."""
    bounded_batches(df.sparkSession)
    hit = "__gt_language"
    return (df.withColumn(hit, predict(F.col(text), model))
            .withColumns({f"{prefix}{c}": F.col(f"{hit}.{c}") for c in ("lang_pred", "score", "ambiguous")}).drop(hit))
