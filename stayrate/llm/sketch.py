"""A count-min sketch spread over the cluster, and the answers it has for each chunk of rows.

Every chunk adds its keys to a sketch of its own, kept as sorted cells with counts and cut into
slices of the cell range. Chunks' slices are merged by adding counts, one task per slice, so no
task holds the whole sketch and nothing of it is broadcast. Each chunk then gets the merged counts
of its own cells back, a byte per cell. Estimates are never below the true counts (up to 255).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.text import mixed

DEPTH = 2
SLICE_BITS = 24
MOST_SLICES_BITS = 6
FIELDS = "chunk long, depth int, slice long, payload binary"


class Shape:
    """Cells of one row of the sketch, ``factor`` times the keys or more, and of one slice.

    A slice has a 64th of the cells, and 16 million at most.
    """

    def __init__(self, keys: int, factor: int = 8) -> None:
        self.width_bits = max(10, int(keys * factor).bit_length())
        self.slice_bits = max(8, min(self.width_bits - MOST_SLICES_BITS, SLICE_BITS))

    def cells(self, keys: np.ndarray, depth: int) -> np.ndarray:
        return mixed(keys, 101 + depth) >> np.uint64(64 - self.width_bits)


def questions(chunk: int, keys: np.ndarray, shape: Shape) -> Iterator[tuple]:
    """(chunk, depth, slice, payload): the sketch of one chunk's keys, slice by slice."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for depth in range(DEPTH):
        cells, counts = np.unique(shape.cells(keys, depth), return_counts=True)
        slices = cells >> np.uint64(shape.slice_bits)
        starts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]) if len(cells) else []
        for start, stop in zip(starts, [*starts[1:], len(cells)]):
            local = (cells[start:stop] & np.uint64((1 << shape.slice_bits) - 1)).astype("<u4")
            steps = np.diff(local, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()
            many = np.minimum(counts[start:stop], 255).astype(np.uint8).tobytes()
            yield chunk, depth, int(slices[start]), squeeze(steps + many)


def opened(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(payload), np.uint8)
    n = len(raw) // 5
    steps = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64).astype(np.int64), raw[4 * n :]


def merge(asked: DataFrame, shape: Shape) -> DataFrame:
    """Rows as asked, with the merged counts of the payload's cells as payload."""
    bits = shape.slice_bits

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << bits, np.uint16)
        parts = rows.column("payload").to_pylist()
        for part in parts:
            cells, counts = opened(part)
            total[cells] = np.minimum(total[cells] + counts, 255)
        squeeze = zstandard.ZstdCompressor(level=3).compress
        merged = [squeeze(total[opened(part)[0]].astype(np.uint8).tobytes()) for part in parts]
        return rows.set_column(rows.schema.get_field_index("payload"), "payload", pa.array(merged, pa.binary()))

    return asked.groupBy("depth", "slice").applyInArrow(add, asked.schema).select(*asked.columns)


def estimates(keys: np.ndarray, answers: pa.Table, shape: Shape) -> np.ndarray:
    """Estimated count of every key of a chunk, from the answers to its questions."""
    best = np.full(len(keys), 255, np.uint8)
    order = sorted(zip(*[answers.column(c).to_pylist() for c in ("depth", "slice", "payload")]), key=lambda x: x[:2])
    for depth in range(DEPTH):
        counts = b"".join(zstandard.decompress(p) for d, _, p in order if d == depth)
        _, at = np.unique(shape.cells(keys, depth), return_inverse=True)
        best = np.minimum(best, np.frombuffer(counts, np.uint8)[at])
    return best


def only(df: DataFrame, kind: int) -> DataFrame:
    return df.where(F.col("kind") == kind).drop("kind")
