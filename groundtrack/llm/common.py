"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtrack.session import ensure_checkpoint_dir

#: A word is a maximal run of code points other than ASCII white space.
#: ``bytes.split()`` finds the same words in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Largest Arrow batch that Spark hands to a Python worker, so that many very
#: long texts never meet in one batch.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session already does."""
    if int(str(spark.conf.get(_BATCH_CONF, str(2**31 - 1))).rstrip("b") or 0) >= 2**31 - 1:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/groundtrack-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts
    its lineage: a lost executor costs no more than the tasks it ran. A task
    writes, and later reads, row groups of about ``group_bytes``."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**({"parquet.block.size": group_bytes} if group_bytes else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system. A Python worker that has ended its task
    waits for the next one, beside those of the stages that follow, and would stay
    as large as it has been."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not every C library can
        pass


def crc_mod(col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary") if isinstance(col, str)
                   else col.cast("string").cast("binary")) % n


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each value, null as empty."""
    for v in column.cast(pa.large_binary()):
        b = v.as_py()
        yield b if b is not None else b""


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to about ``limit`` at most
    (one item at least)."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= start:
        yield start, i + 1


def bounded_sample(df: DataFrame, key: str, stratum: str | Column, per_stratum: int, seed: int = 7) -> DataFrame:
    """About ``per_stratum`` rows of each stratum at most, chosen by a hash of
    the key: the same rows on every run. The strata must be few; their counts
    (one small row each) come to the driver."""
    s = F.col(stratum) if isinstance(stratum, str) else stratum
    counts = {r[0]: r[1] for r in df.groupBy(s.alias("s")).count().collect()}
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 20)) / float(1 << 20)
    keep = F.lit(False)
    for value, n in sorted(counts.items(), key=lambda kv: str(kv[0])):
        keep = keep | (s.eqNullSafe(F.lit(value)) & (unit < min(1.0, per_stratum / max(n, 1))))
    return df.filter(keep)
