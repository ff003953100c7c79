"""Words of UTF-8 text as numpy arrays: spans and hashes without a Python loop.

A prefix polynomial over the bytes, modulo 2**64, gives the hash of any span by
one subtraction and one multiplication, so a batch of texts costs a few passes
over its bytes however many different words it has.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
#: Bytes looked at together; a longer run without white space is taken whole.
CHUNK = 1 << 22

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n + 1:
        n = max(n + 1, 1 << 16)
        _powers = np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
        _inverse = np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE, np.uint64)]).cumprod(dtype=np.uint64)
    return _powers, _inverse


class Hasher:
    """Hashes of spans of one byte array."""

    def __init__(self, data: np.ndarray):
        powers, self._inv = _tables(len(data))
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self._sum[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self._sum[end] - self._sum[start]) * self._inv[start])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals in lower case, byte by byte."""
    out = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    at = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[at] += 0x20
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by a line feed, and the start
    of each (with the total length last)."""
    start = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=start[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), start


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, A-Z in lower case, in order."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text):                       # cut behind the last white space
            cut = np.flatnonzero(SPACES[np.frombuffer(text[at:end], np.uint8)])
            while not len(cut) and end < len(text):
                end = min(len(text), end + CHUNK)
                cut = np.flatnonzero(SPACES[np.frombuffer(text[at:end], np.uint8)])
            end = at + int(cut[-1]) + 1 if len(cut) and end < len(text) else end
        data = np.frombuffer(text[at:end], np.uint8)
        start, stop = runs(~SPACES[data])
        if len(start):
            out.append(Hasher(LOWER[data]).spans(start, stop))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
