"""Chat formatting by columnar byte assembly.

A batch of turns is laid out with array arithmetic: segment lengths, their
cumulative offsets, and scatter indices that copy every header and content
into one preallocated buffer, which becomes the Arrow column itself. No string
is built per turn.

The template writes a turn as::

    ### <role>: <text></turn>\n

Inside roles and texts a backslash goes before every ``#``, ``<`` and
backslash (in roles before ``:`` too), so no content can spell a mark, and
dropping those backslashes gives the content back. The loss mask covers the
contents of the ``train_roles``, as byte spans of the formatted text.

Rows of a conversation stream through one task in turn order; a conversation
becomes one row per Arrow batch that it touches (``piece`` 0, 1, ...), so one
of any length needs a batch of memory.

Defined results: a null text or role is empty; null turns come first; equal
turns go by role and text; repeated rows are kept; a null conversation id is a
conversation of its own; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtrack.llm.common import bounded_batches

OPEN, MIDDLE, CLOSE = b"### ", b": ", b"</turn>\n"
TRAIN_ROLES = ("assistant",)
_BACK = 0x5C


def _escaped(column: pa.Array, also: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All values of a string column with escapes, end to end, and the length of each."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    special = np.isin(raw, np.frombuffer(b"\\#<" + also, np.uint8))
    moved = np.concatenate([[0], np.cumsum(special)])
    out = np.full(len(raw) + int(moved[-1]), _BACK, np.uint8)
    out[np.arange(len(raw)) + moved[1:]] = raw            # an escaped byte leaves its own backslash before it
    at = offsets - offsets[0]
    return out, np.diff(at + moved[at])


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted bytes of a batch of turns: the buffer, the offset of each turn
    (with the total last), and where each content begins and ends."""
    roles, role_n = _escaped(role, b":")
    texts, text_n = _escaped(text)
    turn_n = len(OPEN) + role_n + len(MIDDLE) + text_n + len(CLOSE)
    start = np.concatenate([[0], np.cumsum(turn_n)])
    buffer = np.empty(int(start[-1]), np.uint8)
    at_role = start[:-1] + len(OPEN)
    at_text = at_role + role_n + len(MIDDLE)
    for mark, at in ((OPEN, start[:-1]), (MIDDLE, at_role + role_n), (CLOSE, at_text + text_n)):
        buffer[at[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    for data, n, at in ((roles, role_n, at_role), (texts, text_n, at_text)):
        shift = at - np.concatenate([[0], np.cumsum(n)[:-1]])
        buffer[np.arange(len(data)) + np.repeat(shift, n)] = data
    return buffer, start, at_text, at_text + text_n


def format_chats(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 train_roles: tuple[str, ...] = TRAIN_ROLES) -> DataFrame:
    """Rows (key, piece, formatted, loss): ``loss`` holds the byte spans
    [begin, end) of ``formatted`` that count for the loss. The pieces of a
    conversation lie in one partition, in order."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(key).cast("bigint").alias("k"), F.col(turn).alias("n"), F.col(role).alias("r"), F.col(text).alias("t"))
    rows = rows.repartition("k").sortWithinPartitions("k", "n", "r", "t")
    wanted = pa.array(train_roles, pa.string())
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k, r, t = (batch.column(i) for i in (0, 2, 3))
            buffer, start, begin, end = assemble(r, t)
            keys = k.fill_null(-1).to_numpy(zero_copy_only=False)
            null = k.is_null().to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])]))
            heads = k.take(pa.array(new))
            pieces = np.zeros(len(new), np.int64)
            piece = piece + 1 if last == heads[0].as_py() else 0
            pieces[0] = piece
            if len(new) > 1:
                piece = 0
            last = heads[-1].as_py()
            cut = np.append(start[new], start[-1])
            formatted = pa.LargeStringArray.from_buffers(len(new), pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(buffer)).cast(pa.string())
            train = pc.is_in(r.cast(pa.string()), wanted).to_numpy(zero_copy_only=False)
            owner = np.searchsorted(new, np.flatnonzero(train), side="right") - 1
            spans = pa.StructArray.from_arrays([pa.array(begin[train] - cut[owner]), pa.array(end[train] - cut[owner])], ["begin", "end"])
            per = np.searchsorted(owner, np.arange(len(new) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [heads, pa.array(pieces), formatted, pa.ListArray.from_arrays(pa.array(per), spans).cast(span)],
                ["k", "piece", "formatted", "loss"])

    return (rows.mapInArrow(run, "k bigint, piece bigint, formatted string, loss array<struct<begin: bigint, end: bigint>>")
            .withColumnRenamed("k", key))


_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)
_ESCAPE = re.compile(rb"\\(.)", re.DOTALL)


def unescape(content: bytes) -> bytes:
    return _ESCAPE.sub(rb"\1", content)


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError("not a formatted conversation")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What the output holds, read back piece by piece: per conversation the
    number of turns, a digest over all turns, and size and digest of the text
    under the loss mask. Must follow ``format_chats`` without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row(s):
            return {"k": s[0], "n_turns": s[1], "turns_sha256": s[2].hexdigest(), "loss_chars": s[3], "loss_sha256": s[4].hexdigest(),
                    "formatted_chars": s[5]}

        schema = pa.schema([("k", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            done = []
            for k, piece, text, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or piece == 0:
                    if state is not None:
                        done.append(row(state))
                    state = [k, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = text.encode()
                for role, content in read_turns(raw):
                    state[1] += 1
                    state[2].update(role + b"\n" + content + b"\n")
                for s in loss:
                    content = unescape(raw[s["begin"]:s["end"]])
                    state[3] += len(content.decode())
                    state[4].update(content)
                state[5] += len(text)
            yield pa.RecordBatch.from_pylist(done, schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row(state)], schema)

    return (formatted.select(F.col(key).alias("k"), "piece", "formatted", "loss")
            .mapInArrow(run, "k bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
            .withColumnRenamed("k", key))
