"""A bit table of 64-bit hashes: a broadcast set test of fixed size, whatever the set's.

A hash sets two bits. The table takes about 16 bits a hash, rounded up to a power of two, and never more than
``2 ** MAX_BITS`` bits (32 MB): beyond that more hashes pass that are not in the set, none that is in it fails. So it
only narrows what an exact step then settles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.memory import release

MAX_BITS = 28


def bit_table(hashes: DataFrame, col: str, max_bits: int = MAX_BITS):
    """Broadcast table of the hashes (bigint, not null) in ``col``; summed on the executors, at most 2 ** max_bits bits meet the driver."""
    size = 1 << min(max_bits, max(10, (16 * hashes.count()).bit_length()))
    low = F.col(col).bitwiseAND(F.lit(size - 1))
    high = F.shiftrightunsigned(F.col(col), 64 - size.bit_length() + 1)
    each = hashes.select(F.explode(F.array(low, high)).alias("place"))
    words = (each.select(F.shiftright("place", 6).cast("int").alias("at"), F.col("place").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))).toArrow()
    table = np.zeros(size >> 6, np.uint64)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (int64) pass."""
    h, size = hashes.view(np.uint64), len(table) * 64
    ok = np.ones(len(h), bool)
    for place in (h & np.uint64(size - 1), h >> np.uint64(64 - size.bit_length() + 1)):
        ok &= (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return ok


def passing(hashes: Column, shared) -> Column:
    """Places (from 0) of the hashes of an ``array<bigint>`` that pass the table; NULL in, NULL out."""

    @F.arrow_udf("array<int>")
    def places(rows: pa.Array) -> pa.Array:
        flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.diff(rows.offsets.to_numpy())
        if rows.null_count:
            size = np.where(rows.is_null().to_numpy(zero_copy_only=False), 0, size)
        hit = np.flatnonzero(may_hold(shared.value, flat))
        ends = np.cumsum(size)
        row = np.searchsorted(ends, hit, side="right")
        off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))])
        release()
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(hit - (ends - size)[row], pa.int32()), mask=rows.is_null())

    return places(hashes)
