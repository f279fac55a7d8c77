"""Bloom filters of 64-bit hashes, of bounded size whatever the input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumshift.llm.shipping import arrow_map

FILTER_BITS = 1 << 30
_U = np.uint64


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h & _U(bits - 1), (h >> _U(32)) & _U(bits - 1)


class Filter:
    """Two bits a member; says of every member that it is in, of others hardly ever."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, np.frombuffer(data, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in _places(h, self.bits):
            out &= (self.data[p >> _U(3)] >> (p & _U(7)).astype(np.uint8)) & 1 == 1
        return out


def build(hashes: DataFrame, n: int) -> tuple[int, bytes]:
    """(bits, bitmap) of one column of n hashes.  The size follows n up to FILTER_BITS, which
    bounds what the driver gathers and every worker holds; a fuller filter lets more through."""
    bits = min(FILTER_BITS, 1 << max(16, (16 * max(n, 1)).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in _places(b.column(0).to_numpy(zero_copy_only=False).view(_U), bits):
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64) + 1)], ["p"])

    found = arrow_map(hashes, places, "p long")
    maps = found.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")))
    data = bytearray(max(bits // 8, 4096))
    for bucket, block in maps.collect():                       # at most FILTER_BITS / 8 bytes
        data[(bucket - 1) * 4096:bucket * 4096] = block
    return bits, bytes(data[:bits // 8])
