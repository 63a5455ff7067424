"""Blocked Bloom filter over 64-bit hashes: built by one aggregate, probed by numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 8                      # 64-bit words of a block, one bit set in each
MAX_FILTER_BYTES = 16 << 20    # bound of the broadcast filter; past it only more keys pass

#: Fixed values of the public XXH64 hash, which Spark's xxhash64 follows.
P1, P2, P3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
P4, P5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xx64(values: np.ndarray, seed=42) -> np.ndarray:
    """Spark's ``xxhash64`` of a long column; pass one result as the next column's seed."""
    u = np.asarray(values).astype(np.int64, copy=False).view(np.uint64)
    with np.errstate(over="ignore"):
        h = (np.asarray(seed, dtype=np.uint64) + np.uint64(P5) + np.uint64(8)) ^ (_rotl(u * np.uint64(P2), 31) * np.uint64(P1))
        h = _rotl(h, 27) * np.uint64(P1) + np.uint64(P4)
        h ^= h >> np.uint64(33)
        h *= np.uint64(P2)
        h ^= h >> np.uint64(29)
        h *= np.uint64(P3)
        return h ^ (h >> np.uint64(32))


class BlockedBloom:
    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks          # (n, WORDS) uint64, n a power of two

    @classmethod
    def build(cls, keys: DataFrame, col: str, bits_per_key: int = 16,
              max_bytes: int = MAX_FILTER_BYTES) -> BlockedBloom:
        """Filter of a long column (null: skipped); at most ``max_bytes`` reach the driver."""
        keys = keys.where(F.col(col).isNotNull())
        want = max(1, keys.count() * bits_per_key // (64 * WORDS))
        n = min(1 << (want - 1).bit_length(), max_bytes // (8 * WORDS))
        block = F.shiftrightunsigned(F.xxhash64(col), 16).bitwiseAND(F.lit(n - 1))
        words = [F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {6 * i}) & 63 as int))")).alias(f"w{i}")
                 for i in range(WORDS)]
        got = keys.groupBy(block.alias("b")).agg(*words).toPandas()
        out = np.zeros((n, WORDS), dtype=np.uint64)
        for i in range(WORDS):
            out[got["b"].to_numpy(dtype=np.int64), i] = got[f"w{i}"].to_numpy(dtype=np.int64).view(np.uint64)
        return cls(out)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        u = np.asarray(keys).astype(np.int64, copy=False).view(np.uint64)
        b = (xx64(u.view(np.int64)) >> np.uint64(16)) & np.uint64(len(self.blocks) - 1)
        hit = np.ones(len(u), dtype=bool)
        for i in range(WORDS):
            bit = (u >> np.uint64(6 * i)) & np.uint64(63)
            hit &= ((self.blocks[b.astype(np.int64), i] >> bit) & np.uint64(1)).astype(bool)
        return hit
