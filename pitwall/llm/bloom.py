"""A bit filter of fixed size over 64-bit hashes, built by Spark and broadcast.

Its size does not follow the data: with more keys than it is meant for it answers "maybe"
more often, so it is used only where a false "maybe" costs time and not rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25  # 4 MB


def build(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of a long column as 64-bit words; at most ``BITS / 64`` rows reach the driver."""
    c = F.col(column)
    spots = keys.select(F.explode(F.array(c.bitwiseAND(F.lit(BITS - 1)),
                                          F.shiftrightunsigned(c, 32).bitwiseAND(F.lit(BITS - 1)))).alias("spot"))
    words = (spots.select(F.shiftright("spot", 6).alias("w"),
                          F.expr("shiftleft(1L, cast(spot & 63 AS int))").alias("bit"))
             .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(BITS // 64, dtype=np.uint64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Boolean array: False where a hash is surely not among the keys."""
    def test(spot: np.ndarray) -> np.ndarray:
        return (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1)

    mask = np.uint64(BITS - 1)
    return (test(hashes & mask) & test((hashes >> np.uint64(32)) & mask)).astype(bool)
