"""Native column expressions that several operators use: arrays stay inside one
row, so nothing here shuffles or leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def pieces(text: Column, pattern: str) -> Column:
    """All matches of a pattern, in order."""
    return F.regexp_extract_all(filled(text), F.lit(pattern), F.lit(0))


def hashes(parts: Column) -> Column:
    return F.transform(parts, lambda w: F.xxhash64(w))


def positions(n: Column) -> Column:
    """0 .. n-1 (empty for n <= 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def windows(h: Column, k: int) -> Column:
    """Hash of each run of ``k`` consecutive items of an array of longs."""
    return F.transform(positions(F.size(h) - (k - 1)), lambda i: F.xxhash64(*(h[i + j] for j in range(k))))
