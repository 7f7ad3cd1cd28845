"""A Bloom filter built by Spark and tested in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The filter never gets larger than this many bits (64 MB), enough for some 50 million keys; with more it refuses fewer.
MAX_BITS = 1 << 29
PROBES = 5


def _halves(key: Column) -> tuple[Column, Column]:
    low = F.lit((1 << 32) - 1)
    return F.xxhash64(key).bitwiseAND(low), F.xxhash64(key, F.lit(1)).bitwiseAND(low)


def bloom_filter(keys: DataFrame, key: str, bits_per_key: int = 10, max_bits: int = MAX_BITS):
    """A function Column -> Column that is false only for values that are certainly not among the keys.

    Words of 64 bits are combined on the executors by bit_or; what reaches the driver is the filter, at most
    max_bits / 64 words. Past that bound more values pass; they are for the exact join to decide.
    """
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    bits = 1 << 16
    while bits < bits_per_key * n and bits < max_bits:
        bits *= 2
    a, b = _halves(F.col(key))
    at = keys.where(F.col(key).isNotNull()).select(
        F.explode(F.array(*[(a + b * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)])).alias("at"))
    words = (
        at.groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set"))
        .toPandas()
    )
    filled = np.zeros(bits // 64, np.int64)
    filled[words["word"].to_numpy(np.int64)] = words["set"].to_numpy(np.int64)
    shared = keys.sparkSession.sparkContext.broadcast(filled.view(np.uint64))

    @F.pandas_udf(T.BooleanType())
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        words, x, y = shared.value, a.to_numpy(np.int64), b.to_numpy(np.int64)
        ok = np.ones(len(x), bool)
        for i in range(PROBES):
            at = (x + y * i) & (bits - 1)
            ok &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(ok)

    def test(value: Column) -> Column:
        return F.coalesce(passes(*_halves(F.coalesce(value, F.lit("")))), F.lit(False))

    return test
