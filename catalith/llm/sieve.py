"""A bit table of fixed size that says which keys cannot be in a set.

The set is hashed into at most `1 << MAX_BITS` bits (32 MB), whatever its size, so
the table may be broadcast. It only spares work: a key that passes is looked up
exactly later, and a set too large for the table makes more keys pass, never fewer.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_BITS, MAX_BITS = 16, 28
BITS_PER_KEY = 16


class Sieve:
    """Broadcast as `parts`, plain numbers: tasks need not have this package."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    @property
    def parts(self) -> tuple[np.ndarray, int]:
        return self.table, self.bits

    def passes(self, keys: np.ndarray) -> np.ndarray:
        """True for each key of the set, and for few others."""
        keys = keys.astype(np.uint64, copy=False)
        out = np.ones(len(keys), bool)
        for at in (keys >> np.uint64(64 - self.bits), keys & np.uint64((1 << self.bits) - 1)):
            out &= (self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
        return out


def build(keys: DataFrame, column: str) -> Sieve:
    """The sieve of a bigint column of well-mixed hashes; nulls are left out."""
    n = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, (BITS_PER_KEY * max(n, 1)).bit_length()))
    known = keys.where(F.col(column).isNotNull())
    ends = F.shiftrightunsigned(column, 64 - bits), F.col(column).bitwiseAND((1 << bits) - 1)
    places = known.select(F.explode(F.array(*ends)).alias("at"))
    words = (
        places.select(F.shiftright("at", 6).alias("word"), F.col("at").bitwiseAND(63).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.uint64)
    return Sieve(table, bits)
