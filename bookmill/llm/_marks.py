"""A bounded set of hashes that is sent to all workers, so that rows that aren't in it needn't be dealt out.

A bit for each value of the hash's upper bits: rows in the set are always marked, others seldom, and the more
the set holds, the more of them. What is marked must be looked up exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ._hashing import U

#: Bits of the set: 4 MB, whatever the number of rows.
BITS = 25
_BLOCK = 1 << 15


def marks(hashes: DataFrame) -> Broadcast:
    """The set of the hashes in the first column."""
    at = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - BITS)
    placed = hashes.select(F.floor(at / _BLOCK).cast("int").alias("block"), (at % _BLOCK).alias("bit"))
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in placed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # at most 1024 rows of 4 KB
        out[r["block"] * _BLOCK // 8 : (r["block"] + 1) * _BLOCK // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out)


def marked(sent: Broadcast, h: Column) -> Column:
    """Whether a hash may be in the set. Only the hash goes to Python."""

    @F.pandas_udf("boolean")
    def test(x: pd.Series) -> pd.Series:
        at = (x.to_numpy().view(np.uint64) >> U(64 - BITS)).astype(np.int64)
        return pd.Series((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return test(h)
