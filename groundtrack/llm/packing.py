"""Packing token sequences by concatenate and cut.

Two passes of prefix sums: the first tokenizes each partition of the input,
gives every document its offset in the partition's stream and writes ids and
offsets; the partitions' totals, one small row each, add up to the partitions'
global offsets. In the second pass every document knows its place in the one
global stream, which is cut into windows of ``length`` ids; a document that
crosses a cut leaves a boundary record in each window it touches. Nothing is
sorted and no text moves; only the last window is not full, and is padded
unless its length is a power of two.

Defined results: a null text counts as empty and packs its end id alone; an
empty table gives no piece; repeated rows and ids are packed each by itself;
the order is that of the input's partitions, so it may differ between runs over
differently split input, while each id always lies in exactly one piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches, give_back, saved, slices

LENGTH, END_ID, PAD_ID = 1024, 0, 0
#: Ids of about so many documents' bytes leave a Python worker at a time, and lie
#: in a row group of the written tokens: tasks of one executor hold few of them.
PART_BYTES, GROUP_BYTES = 1 << 20, 8 << 20
_encoders: dict[str, object] = {}


def _byte_of() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


#: The rule by which a file of this kind says that it splits text into words.
SPLIT_RULE = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: That rule's pattern (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run of so many blanks, or of anything else, is one long word for some pattern.
_ENDLESS = re.compile(r"\s{20000}|\S{20000}")


class Encoder:
    """Ids of a tokenizer file, as the ``tokenizers`` library gives them without
    special tokens added. Where the file is a byte-level BPE with the usual split
    rule, texts go through ``tiktoken``, which has the same merges by rank and is
    several times faster; texts that spell one of the file's special tokens or
    hold an endless word (``tiktoken`` ends the process on the longest), and all
    texts of a file with another rule, go through ``tokenizers`` itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._path, self._slow, self._fast = path, None, None
        self._special = tuple(t["content"] for t in spec.get("added_tokens", []))
        model = spec["model"]
        odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] == "BPE" and spec["pre_tokenizer"] == SPLIT_RULE and not spec.get("normalizer") and not odd:
            import tiktoken
            stand_in = _byte_of()
            ranks = {bytes(stand_in[c] for c in token): i for token, i in model["vocab"].items() if token not in self._special}
            self._fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self._fast and not any(s in text for s in self._special) and not (len(text) >= 20_000 and _ENDLESS.search(text)):
            return self._fast.encode_ordinary(text)
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(self._path)
        return self._slow.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    """The encoder of a file, made once per task (in 0.15 s)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def end_task() -> None:
    """An idle worker holds no encoder and no freed memory."""
    _encoders.clear()
    give_back()


def tokenized(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """First pass, written out: key, part, at (ids before it in the part), n and
    the ids as little-endian unsigned 32-bit numbers."""
    bounded_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at = TaskContext.get().partitionId(), 0
        for pdf in batches:
            texts = pdf["t"].fillna("")
            for a, z in slices(map(len, texts), PART_BYTES):
                ids = [np.array(encoder(path)(t), "<u4").tobytes() + end for t in texts.iloc[a:z]]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                yield pd.DataFrame({"k": pdf["k"].to_numpy()[a:z], "part": part, "at": at + np.cumsum(n) - n, "n": n, "ids": ids})
                at += int(n.sum())
        pdf = texts = ids = None
        end_task()

    # as text: pandas would round large ids beside a null one
    return saved(df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"))
                 .mapInPandas(run, "k string, part int, at bigint, n bigint, ids binary")
                 .withColumn("k", F.col("k").cast(kind)), "tokens", GROUP_BYTES)


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Boundary records of the windows: key, start, length, doc_tokens,
    sequence_id, offset and the piece's ids (unsigned 32-bit, little endian)."""
    docs = tokenized(df, path, key, text, end_id)
    totals = docs.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total")).orderBy("part").collect()  # one row a partition
    before, offsets = 0, {}
    for r in totals:
        offsets[r["part"]] = before
        before += r["total"]
    shared = df.sparkSession.sparkContext.broadcast(offsets)
    kind = docs.schema["k"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for a, z in slices(4 * whole["n"], PART_BYTES):
                pdf = whole.iloc[a:z]
                begin = pdf["at"].to_numpy() + pdf["part"].map(shared.value).to_numpy()
                n = pdf["n"].to_numpy()
                first = begin // length
                count = (begin + n - 1) // length - first + 1
                doc = np.repeat(np.arange(len(pdf)), count)
                window = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                lo = np.maximum(window * length, begin[doc])
                hi = np.minimum((window + 1) * length, (begin + n)[doc])
                ids, start = pdf["ids"].to_numpy(), lo - begin[doc]
                yield pd.DataFrame({
                    "k": pdf["k"].to_numpy()[doc], "start": start, "length": hi - lo, "doc_tokens": n[doc], "sequence_id": window,
                    "offset": lo - window * length,
                    "ids": [bytes(ids[d][4 * at:4 * (at + m)]) for d, at, m in zip(doc, start, hi - lo, strict=True)]})
        whole = pdf = ids = None
        end_task()

    return (docs.withColumn("k", F.col("k").cast("string"))
            .mapInPandas(cut, "k string, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
            .withColumn("k", F.col("k").cast(kind)).withColumnRenamed("k", key))


def with_crc(pieces: DataFrame) -> DataFrame:
    """``ids_crc32`` of each piece instead of its ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = PAD_ID) -> DataFrame:
    """The windows as token arrays: sequence_id, n_tokens, ids (padded to
    ``length`` unless their number is a power of two). At most ``length``
    pieces meet in one."""
    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(map(bytes, pdf.sort_values("offset")["ids"])), "<u4").astype(np.int64)
        n = len(ids)
        pad = 0 if n & (n - 1) == 0 else length - n
        return pd.DataFrame({"sequence_id": [pdf["sequence_id"].iloc[0]], "n_tokens": [n],
                             "ids": [np.concatenate([ids, np.full(pad, pad_id, np.int64)])]})
    return pieces.groupBy("sequence_id").applyInPandas(whole, "sequence_id bigint, n_tokens bigint, ids array<bigint>")
