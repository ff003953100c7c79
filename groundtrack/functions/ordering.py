"""An exact, hash-aggregatable ordering key for ``(timestamp, seq)``.

``max_by(x, struct(ts, seq))`` is exact but its struct buffer forces Spark
into a sort-based aggregate. Packing the pair into one DECIMAL(38,0),
``ts * 2^64 + (seq + 2^63)``, keeps the order exactly (seq fills the low 64
bits) and lets ``max_by``/``min_by`` run in a hash aggregate. Valid while
``|ts| < 5.4e18`` (epoch seconds are ~1.7e9). A null ``seq`` sorts below
every offset of the same second; a null ``ts`` gives a null key (the row
cannot be "latest").
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_D = "decimal(38,0)"


def order_key(ts="timestamp", seq="seq") -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    s = F.col(seq) if isinstance(seq, str) else seq
    low = F.coalesce(s.cast(_D), F.lit(Decimal(-(2 ** 63))).cast(_D))   # no offset: lowest
    return (t.cast(_D) * F.lit(Decimal(2 ** 64)).cast(_D)
            + (low + F.lit(Decimal(2 ** 63)).cast(_D))).cast(_D)
