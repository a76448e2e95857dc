"""A bit per hash: a filter of fixed size that never drops what it was made of."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 28


def hash_filter(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Words of 64 bits, with a bit set for each value of ``column``, a well mixed 64-bit hash.

    ``bits``, a power of two, sets its size (the default takes 32 MB), whatever the number of hashes. A filter that fills up lets
    more pass, so it may only save work. Bits are set by word before the shuffle; the driver gets the words.
    """
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    bit: Column = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = hashes.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True for every hash that the filter was made of, and for a few others."""
    place = hashes.view(np.uint64) & np.uint64(64 * len(table) - 1)
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
