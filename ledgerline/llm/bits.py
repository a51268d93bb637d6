"""A bitmap of hashes of fixed size, for filters that may let too much through but never too little."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class HashBits:
    """Marks 64-bit hashes by their low bits.

    Its size is the parameter `bits` alone, whatever the data, so it may be sent
    to every task.  A hash that was added is always found; one that was not may
    be found too, so what passes must still be joined exactly.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.mask = words, (1 << bits) - 1

    @classmethod
    def of(cls, hashes: DataFrame, column: Column, bits: int = 24) -> "HashBits":
        """Built by the executors; the driver receives at most 2**(bits - 6) words."""
        place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
        words = (
            hashes.select(column.alias("h"))
            .filter("h IS NOT NULL")
            .groupBy(F.shiftright(place, 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS int))")).alias("word"))
            .toArrow()
        )
        out = np.zeros(1 << max(bits - 6, 0), np.int64)
        out[words.column("at").to_numpy()] = words.column("word").to_numpy()
        return cls(out.view(np.uint64), bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """For each unsigned 64-bit hash: may it have been added?"""
        place = hashes & np.uint64(self.mask)
        word = self.words[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) != 0
