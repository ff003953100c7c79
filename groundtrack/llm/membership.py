"""A bounded filter in front of joins against few ids.

Joining wide rows (texts) to a small share of their ids moves every row. A
Bloom filter of fixed size, built by an aggregate and shared with the tasks,
lets most rows that cannot match stay where they are; the join itself decides
on the others, so results are exact at every size. More ids than the filter is
made for only let more rows through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

BITS = 1 << 26                 # 8 MB


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), key.cast("bigint")), F.lit(bits)) for seed in (1, 2)]


def may_be_in(ids: DataFrame, bits: int = BITS):
    """A function of a key column: false only if the key is not in ``ids`` (one
    integer column). A null key may be in it."""
    place = F.explode(F.array(*_places(F.col(ids.columns[0]), bits)))
    words = (ids.select(place.alias("p")).groupBy(F.expr("p div 64").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("m")).toPandas())     # bits / 64 rows at most
    table = np.zeros(bits // 64, np.uint64)
    table[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(BooleanType())
    def hit(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.ones(len(a), bool)
        for p in (a.to_numpy(np.int64), b.to_numpy(np.int64)):
            out &= (shared.value[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(out)

    return lambda key: key.isNull() | hit(*_places(key, bits))
