"""A Bloom filter in blocks: built by Spark tasks, and either small enough to be broadcast or left as a table of blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.common import materialize

BLOCK_BITS = 11  # the first bits of a key say which of 2,048 blocks it is in
PROBES = 4
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit keys for each salt."""
    x = (keys ^ np.uint64((salt * 0xD1342543DE82EF95) & (1 << 64) - 1)) * _ODD[0]
    x ^= x >> np.uint64(32)
    x *= _ODD[1]
    return x ^ (x >> np.uint64(29))


def spots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each probe the place in a block of 2**bits bits."""
    out, x, y = [], mix(keys, 1), mix(keys, 2) | np.uint64(1)
    for probe in range(PROBES):
        out.append((x + np.uint64(probe) * y) & np.uint64((1 << bits) - 1))
    return out


class Bloom:
    """words: all blocks behind one another; 2**bits bits each. With block_bits = 0 it is a single block."""

    def __init__(self, words: np.ndarray, bits: int, block_bits: int = BLOCK_BITS) -> None:
        self.words, self.bits, self.block_bits = words, bits, block_bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        block = (keys >> np.uint64(64 - self.block_bits)) << np.uint64(self.bits) if self.block_bits else np.uint64(0)
        out = np.ones(len(keys), bool)
        for spot in spots(keys, self.bits):
            place = block + spot
            out &= (self.words[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def bits_for(keys: int) -> int:
    """Bits of a whole filter, as a power of two: 10 to 20 for each key."""
    return max(int(10 * keys).bit_length(), BLOCK_BITS + 6)


def size_for(keys: int, most_bytes: int) -> int:
    """Bits of a block, as a power of two: 10 bits for a key or more, but no more than most_bytes in all."""
    return min(bits_for(keys), (8 * most_bytes).bit_length() - 1) - BLOCK_BITS


def blocks(rows: DataFrame, bits: int, spread: Callable[[pa.RecordBatch], np.ndarray], block_bits: int = BLOCK_BITS) -> DataFrame:
    """(block, bits): the blocks set by the keys that `spread` makes of a batch, 2**bits / 8 bytes each. Every task gives each
    block it has keys of once, so `rows` should be dealt by block; the rows of a block are to be joined by OR."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = spread(batch)
            keys = keys[np.argsort(keys >> np.uint64(64 - block_bits), kind="stable")]
            number = (keys >> np.uint64(64 - block_bits)).astype(np.int64)
            cuts = np.concatenate([[0], np.nonzero(np.diff(number))[0] + 1, [len(number)]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo < hi:
                    block = own.setdefault(int(number[lo]), np.zeros(1 << bits - 3, np.uint8))
                    for spot in spots(keys[lo:hi], bits):
                        np.bitwise_or.at(block, spot >> np.uint64(3), np.uint8(1) << (spot & np.uint64(7)).astype(np.uint8))
        for number, block in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([block.tobytes()], pa.binary())], names=["block", "bits"])

    # Written first: an iterator over the tasks would run them one after another.
    return materialize(rows.mapInArrow(run, "block int, bits binary"), "bloom")


def collect(rows: DataFrame, bits: int, spread: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The whole filter as it comes to the driver, whatever the number of keys."""
    out = np.zeros(1 << bits - 3 + BLOCK_BITS, np.uint8)
    for number, block in blocks(rows, bits, spread).toLocalIterator():
        out[number << bits - 3:number + 1 << bits - 3] |= np.frombuffer(block, np.uint8)
    return out
