"""A bit table of a column of hashes: a filter of fixed size, whatever the number of rows.

It only spares rows that a later join would drop. The more rows it is made of, the more it lets through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BITS = 24


def bit_table(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Bits set at the low bits of the column's longs; at most 2**(bits - 6) sums come to the driver, 2 MB of them."""
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = df.select(F.shiftright(low, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (bits - 6), np.int64)
    rows = words.toPandas()
    out[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64)
    return out.view(np.uint64)


def holds(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    return (found[((h >> np.uint64(6)) & np.uint64(len(found) - 1)).view(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) != 0
