"""Bloom filters of a fixed size, which spare moving rows that have no match."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bloom_bits(hashes: DataFrame, n_bits: int) -> np.ndarray:
    """A Bloom filter of a column of 64-bit hashes, two places each, as n_bits / 8 bytes whatever the rows (a power of two of bits)."""
    (h,), bits = hashes.columns, np.zeros(n_bits // 8, np.uint8)
    places = F.explode(F.array(F.expr(f"{h} & {n_bits - 1}"), F.expr(f"shiftrightunsigned({h}, 32) & {n_bits - 1}"))).alias("p")
    parts = hashes.select(places).groupBy(F.expr("shiftright(p, 15)").alias("part")).agg(F.bitmap_construct_agg(F.expr("p & 32767")).alias("bits"))
    for row in parts.toLocalIterator():
        bits[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return bits


def maybe_in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether int64 hashes may be in a Bloom filter; those that are in it always may."""
    h, mask = hashes.view(np.uint64), np.uint64(8 * len(bits) - 1)
    found = np.ones(len(h), bool)
    for p in (h & mask, (h >> np.uint64(32)) & mask):
        found &= (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found
