"""Which hashes repeat, as a bit set that tasks test rows against without a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 16, 26  # a set takes up to 8 MB, and the driver at most 2^20 words of it
ROOM = 4  # bits to a hash, as a power of two: one other hash in sixteen passes


def repeated(hashes: DataFrame, name: str = "h") -> DataFrame:
    """The values of ``name`` that occur more than once."""
    return hashes.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)


def may_hold(keys: DataFrame, name: str, hash_: Column) -> Column | None:
    """Whether ``hash_`` may be among the 64-bit hashes ``keys``; ``None`` if there are none.

    Never false for one that is. The set has sixteen bits to a hash, up to its largest size; beyond
    that more others pass. ``keys`` is read twice: pass a staged table.
    """
    n = keys.count()
    if not n:
        return None
    bits = min(max(LEAST_BITS, (n - 1).bit_length() + ROOM), MOST_BITS)
    slot = F.shiftrightunsigned(name, 64 - bits)
    parts = keys.select(F.shiftright(slot, 6).alias("w"), slot.bitwiseAND(63).cast("int").alias("b"))
    found = parts.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    held = keys.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def passes(slots: pa.Array) -> pa.Array:
        at = slots.to_numpy(zero_copy_only=False)
        return pa.array((held.value[at >> 6] >> (at & 63)) & 1 == 1)

    return passes(F.shiftrightunsigned(hash_, 64 - bits))
