"""Bloom filters for hashes seen once and seen twice, built where the data are.

Each task fills its own pair of filters and emits the parts that are not empty; parts of the same
stretch meet in one task. A bit set by two tasks counts as seen twice there, so a hash that two
tasks hold is always found in the merged twice-filter. A filter has at most ``MOST_BITS`` bits
however many hashes there are; beyond what it can tell apart it lets more through, never less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 4
STRETCH = 1 << 14  # bytes
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
_PARTS = "stretch int, once binary, twice binary"


def filter_bits(hashes: int) -> int:
    """Sixteen bits a hash, as a power of two within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(1, hashes) - 1).bit_length()))


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    low, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (low + probes * step) & np.uint64(bits - 1)


def _hit(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    mask = (1 << (places & np.uint64(7))).astype(np.uint8)
    return ((bitmap[places >> np.uint64(3)] & mask) != 0).all(axis=0)


def _set(bitmap: np.ndarray, places: np.ndarray) -> None:
    mask = (1 << (places & np.uint64(7))).astype(np.uint8)
    np.bitwise_or.at(bitmap, (places >> np.uint64(3)).ravel(), mask.ravel())


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash whether it may be in the filter."""
    return _hit(bitmap, _places(hashes, len(bitmap) * 8))


def _packed(bitmaps: np.ndarray) -> bytes:
    return zstandard.compress(bitmaps.tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), np.uint8)


def seen_twice(
    df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int, once: bool = False
) -> np.ndarray:
    """The filter of all hashes that two rows hold, or with ``once`` of all hashes.

    ``hashes`` takes a batch of ``df`` and returns the hashes of its rows, each hash once for a row.
    What reaches the driver is the filter itself: ``bits`` bits at most, whatever the input.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            found, n = np.unique(hashes(batch), return_counts=True)
            for i in range(0, len(found), 1 << 16):
                places = _places(found[i : i + (1 << 16)], bits)
                if not once:
                    again = _hit(one, places) | (n[i : i + (1 << 16)] > 1)
                    _set(two, places[:, again])
                _set(one, places)
        for k, (a, b) in enumerate(zip(one.reshape(-1, STRETCH), two.reshape(-1, STRETCH))):
            if a.any():
                yield pa.RecordBatch.from_pylist(
                    [{"stretch": k, "once": _packed(a), "twice": _packed(b)}], schema=_SCHEMA
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                a, b = _unpacked(row["once"]), _unpacked(row["twice"])
                if row["stretch"] in kept:
                    one, two = kept[row["stretch"]]
                    a, b = one | a, two | b | (one & a)
                kept[row["stretch"]] = a, b
        for k, (a, b) in kept.items():
            yield pa.RecordBatch.from_pylist([{"stretch": k, "once": _packed(a), "twice": _packed(b)}], schema=_SCHEMA)

    parts = df.mapInArrow(fill, _PARTS)
    merged = parts.repartition(df.sparkSession.sparkContext.defaultParallelism, "stretch").mapInArrow(merge, _PARTS)
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.select("stretch", F.col("once" if once else "twice").alias("part")).collect():
        out[row["stretch"] * STRETCH : (row["stretch"] + 1) * STRETCH] = _unpacked(bytes(row["part"]))
    return out


_SCHEMA = pa.schema([("stretch", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
