"""A Bloom filter of fixed size, to send through a shuffle only the rows that may be needed.

Its size does not grow with the data; where more keys are set than it has
room for, more rows pass and only speed is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def bit(column: str) -> Column:
    """The place of a value of any type."""
    return F.pmod(F.xxhash64(column), F.lit(BITS))


def digest_bit(column: str) -> Column:
    """The place of a uniformly distributed binary digest: its first three bytes."""
    return F.conv(F.substring(F.hex(column), 1, 6), 16, 10).cast("long") % F.lit(BITS)


def digest_bits(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:3]) for d in digests], np.int64) % BITS


def build(keys: DataFrame, place: Column) -> np.ndarray:
    """The filter over the places of all rows, set bits combined by Spark word by word."""
    words = keys.select(place.alias("bit")).selectExpr("cast(bit div 32 as int) at", "shiftleft(1L, cast(bit % 32 as int)) b")
    out = np.zeros(BITS // 32, np.uint32)
    for r in words.groupBy("at").agg(F.bit_or("b").alias("b")).toLocalIterator():
        out[r["at"]] = r.b
    return out


def passes(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the places are set."""
    return ((bits[at // 32] >> (at % 32).astype(np.uint32)) & 1).astype(bool)
