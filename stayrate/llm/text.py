"""Words, word hashes and word n-grams of whole texts, for functions that run in tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, kept for the words met last; memory stays bounded."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries; empty where there are fewer."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    base = MULTIPLY + np.uint64(2 * seed)
    total = words[:size].copy()
    for k in range(1, n):
        total *= base
        total += words[k : k + size]
    return mixed(total, seed)


def pieces(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``most_bytes`` of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if x is None else x for x in pc.binary_length(batch.column(text)).to_pylist()], np.int64)
        ends = np.cumsum(sizes + 16)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Returns freed memory of this Python worker to the system: workers serve one stage after another,
    and what one leaves behind would count beside what the next one needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # no such function outside of glibc
        pass


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as bytes; NULL becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def packed(batch: pa.RecordBatch) -> bytes:
    """Rows with all their columns as one compressed value."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()
