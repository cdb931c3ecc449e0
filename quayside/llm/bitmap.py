"""A set of hashes as a bitmap of a greatest size, to spare rows the way through a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 16 for each hash in it, 32 MB at most.
MOST_BITS = 1 << 28


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """A bit for each hash of a column. What reaches the driver has a greatest size whatever the column holds."""
    wanted = 16 * max(df.count(), 64)
    bits = min(1 << (wanted - 1).bit_length(), MOST_BITS)
    place = F.pmod(F.col(column), F.lit(bits))
    rows = df.select(F.shiftright(place, 6).alias("w"), F.pmod(place, F.lit(64)).cast("int").alias("at")).selectExpr("w", "shiftleft(1L, at) as b")
    table = rows.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[np.asarray(table["w"])] = np.asarray(table["b"]).view(np.uint64)
    return out


def among(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes may be in the set: all that are, and by chance a few others."""
    place = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
