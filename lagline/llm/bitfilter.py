"""A filter of fixed size over row keys: rows that it rejects need not be shuffled to a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26  # 2^26 bits, 8 MB, at any size of the input


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)


def passes(keys: DataFrame, name: str, key: Column) -> Column:
    """Whether ``key`` may be among the column ``name`` of ``keys``; never false for one that is.

    The bits are gathered word by word, so the driver gets at most 2^20 words.
    """
    slots = keys.select(_slot(F.col(name)).alias("s")).select(F.shiftright("s", 6).alias("w"), F.col("s").bitwiseAND(63).cast("int").alias("b"))
    found = slots.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    held = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def set_bit(slots):
        slots = slots.to_numpy()
        import pandas as pd

        return pd.Series((held.value[slots >> 6] >> (slots & 63)) & 1 == 1)

    return set_bit(_slot(key))
