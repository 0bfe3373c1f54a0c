"""Broadcast bitmaps of 64-bit hashes: a bounded filter that never misses a member."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each hash, and the least and most bits of a bitmap (64 MB). Beyond that more non-members pass.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 18, 1 << 29
#: Bits that come to the driver at once: every part is a job of its own.
PART_BITS = 1 << 25


def hash_bits(hashes: DataFrame) -> Broadcast:
    """The longs of the only column as a broadcast bitmap, of a size between LEAST_BITS and MOST_BITS."""
    spark = hashes.sparkSession
    name = hashes.columns[0]
    n = LEAST_BITS
    while n < min(MOST_BITS, BITS_EACH * hashes.count()):
        n *= 2
    at = F.col(name).bitwiseAND(F.lit(n - 1)) + 1  # Spark's bitmap functions count from one
    blocks = (hashes.select(F.bitmap_bucket_number(at).alias("block"), F.bitmap_bit_position(at).alias("bit"))
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))
    bits = np.zeros(n // 8, np.uint8)
    for row in blocks.coalesce(-(-n // PART_BITS)).toLocalIterator():
        own = np.frombuffer(bytes(row.bits), np.uint8)
        start = (row.block - 1) * len(own)
        bits[start:start + len(own)] = own[:max(0, len(bits) - start)]
    return spark.sparkContext.broadcast(bits)


def hit(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes may be members (all, without a bitmap)."""
    if bits is None:
        return np.ones(len(hashes), bool)
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
