"""A Bloom filter of 64-bit hashes, of bounded size, for Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of a filter: about 16 a hash between these.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C[1]
    x = (x ^ (x >> np.uint64(27))) * _C[2]
    return x ^ (x >> np.uint64(31))


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return h & mask, mix(h + _C[0]) & mask


def bloom_filter(hashes: DataFrame) -> np.ndarray:
    """Filter of a table's one column of hashes (bigint, already cut): two bits
    each, 32 MB at most; beyond that it lets more through.  Only its own bytes
    come to the driver, by blocks of 64 kB."""
    n = hashes.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(1, n) - 1).bit_length()))

    def run(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in _places(batch.column(0).to_numpy().view(np.uint64), bits):
                block_no = at >> np.uint64(19)
                for no in np.unique(block_no).tolist():
                    here = (at[block_no == no] & np.uint64((1 << 19) - 1)).astype(np.int64)
                    block = blocks.setdefault(no, np.zeros(1 << 16, np.uint8))
                    np.bitwise_or.at(block, here >> 3, (128 >> (here & 7)).astype(np.uint8))
        for no, block in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([no], pa.int64()), pa.array([block.tobytes()], pa.binary())], ["no", "block"])

    out = np.zeros(bits // 8, np.uint8)
    for row in hashes.coalesce(max(1, bits >> 25)).mapInArrow(run, "no bigint, block binary").toLocalIterator():
        out[row["no"] << 16 : (row["no"] + 1) << 16] |= np.frombuffer(row["block"], np.uint8)
    return out


def inside(filter_bytes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of the hashes (uint64)."""
    ok = np.ones(len(h), bool)
    for at in _places(h, len(filter_bytes) * 8):
        ok &= (filter_bytes[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return ok
