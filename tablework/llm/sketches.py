"""Bloom filters of fixed size, built by Spark and handed to the tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.words import seeded


def slots(keys: np.ndarray, log_bits: int, hashes: int) -> np.ndarray:
    """The bits of each key, one row per hash."""
    return np.stack([seeded(keys, k) >> np.uint64(64 - log_bits) for k in range(hashes)])


class Bloom:
    """A set of 64-bit keys in ``2 ** log_bits`` bits: no false negatives, and its size never grows."""

    def __init__(self, log_bits: int, hashes: int, filled: np.ndarray):
        self.log_bits, self.hashes, self.filled = log_bits, hashes, filled

    def __contains__(self, key) -> bool:
        return bool(self.holds(np.array([key], np.uint64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys) or not len(self.filled):
            return np.zeros(len(keys), bool)
        found = np.ones(len(keys), bool)
        for k in range(self.hashes):
            at = np.flatnonzero(found)  # most keys are gone after the first hash
            if not len(at):
                break
            bit = seeded(keys[at], k) >> np.uint64(64 - self.log_bits)
            found[at] = (self.filled[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)
        return found


def bloom(keys: DataFrame, column: str, log_bits: int = 22, hashes: int = 2) -> Bloom:
    """A filter of a column of 64-bit keys. The driver gets at most ``2 ** (log_bits - 6)`` rows, whatever the input."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            bit = np.unique(slots(some, log_bits, hashes))
            mask = np.uint64(1) << (bit & np.uint64(63))
            yield pa.RecordBatch.from_arrays(
                [pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])

    masks = keys.select(column).mapInArrow(bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    found = masks.toArrow()
    filled = np.zeros(1 << (log_bits - 6), np.uint64)
    filled[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return Bloom(log_bits, hashes, filled if found.num_rows else np.zeros(0, np.uint64))
