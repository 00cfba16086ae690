"""Bitmaps of hashes: a membership test of a fixed size that never misses a member."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARTS = 256


def places(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes & np.uint64(8 * size - 1)).astype(np.int64)


def contains(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = places(hashes, bits.size)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def build(hashes: DataFrame, size: int) -> np.ndarray:
    """Bitmap of `size` bytes, a power of two, of the only column of `hashes`, a long.

    Each part of the bitmap is made by one task and reaches the driver as bytes: `size` bytes
    in all, whatever the number of hashes.
    """
    part = size // _PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.sort(places(batch.column(0).to_numpy().view(np.uint64), size))
            owner = at // (8 * part)
            for p in np.unique(owner).tolist():
                bits = found.setdefault(p, np.zeros(8 * part, bool))
                bits[at[np.searchsorted(owner, p) : np.searchsorted(owner, p, "right")] - 8 * part * p] = True
        if found:
            packed = [np.packbits(b, bitorder="little").tobytes() for b in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array(packed, pa.binary())], ["part", "bits"])

    hash_ = F.col(hashes.columns[0])
    dealt = hashes.select(
        hash_.alias("hash"), (F.pmod(hash_, F.lit(8 * size)) / (8 * part)).cast("int").alias("part")).repartition("part")
    out = np.zeros(size, np.uint8)
    for row in dealt.select("hash").mapInArrow(run, "part long, bits binary").collect():
        out[row["part"] * part : (row["part"] + 1) * part] |= np.frombuffer(row["bits"], np.uint8)
    return out
