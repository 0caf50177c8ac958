"""Vectorised work on whole texts inside a task.

A batch of texts is one byte buffer with offsets.  Words are runs of bytes other
than the six ASCII white-space bytes, which never occur inside a multi-byte
character.  Hashes mix the bytes of a word eight at a time with their place, and runs of
words by doubling; no step is linear, so texts of a regular order do not collide.  Where a
wrong result would follow from equal hashes, 128 bits or the bytes themselves decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 20

PLACE = np.uint64(0x9E3779B97F4A7C15)
SIZE = np.uint64(0xD6E8FEB86659FD93)
#: What is left of eight bytes when only so many belong to a word.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space and ASCII punctuation; what is left are letters, digits and all non-ASCII characters.
LOOSE = np.ones(256, bool)
LOOSE[48:58] = LOOSE[65:91] = LOOSE[97:123] = LOOSE[128:] = False


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser, so that every input bit reaches every output bit."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of words, eight at a time in a row; the number of each eight in its word, and
    where each word's begin.  An empty word has one."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    count = np.maximum((ends - starts + 7) >> 3, 1)
    first = np.cumsum(count) - count
    place = np.arange(count.sum()) - np.repeat(first, count)
    at = np.repeat(starts, count) + 8 * place
    return eights[at] & FIRST_BYTES[np.minimum(np.repeat(ends, count) - at, 8)], place, first


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: the sum of its mixed parts of eight bytes, each mixed once
    more with its place.  Hashes of two salts are independent."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    part, place, first = bytes_at(data, starts, ends)
    part = mix(mix(part, salt) + place.astype(np.uint64) * PLACE, salt)
    return mix(np.add.reduceat(part, first) + (ends - starts).astype(np.uint64) * SIZE)


class Texts:
    """Some whole texts of a batch: ``data`` with ``off``, and their words.

    ``first[d] : first[d + 1]`` are the words of text ``d``; a word's bytes are
    ``data[starts[w] : ends[w]]``.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, apart: np.ndarray = WHITE) -> None:
        self.data, self.off = data, off
        n = len(data)
        inside = ~apart[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before &= ~edge[:n]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, off)

    def __len__(self) -> int:
        return len(self.off) - 1

    def word_hashes(self, salt: int = 0) -> np.ndarray:
        return hashed(self.data, self.starts, self.ends, salt)

    def room(self) -> np.ndarray:
        """For each word, how many words its text has from it on."""
        counts = np.diff(self.first)
        return np.repeat(self.first[1:], counts) - np.arange(len(self.starts))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once; numpy's own way through a hash table takes several times as long."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a + mix(b, 0xA0761D6478BD642F))


def runs(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``k`` words from each word on; the last ``k - 1`` are left out.  Runs are put
    together by doubling, and each step mixes, so no order of words cancels another."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    n, out = 1, mix(hashes, salt)
    while 2 * n <= k:
        out, n = _pair(out[:-n], out[n:]), 2 * n
    return _pair(out[:m], out[k - n:k - n + m]) if n < k else out[:m]


def pieces(column: pa.Array, limit: int = CHUNK_BYTES, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``limit`` bytes: first
    row, row after the last, bytes, offsets.  Null texts are empty."""
    if lower:  # run by run, so that a batch is never held twice
        for at, to, _, _ in pieces(column, limit):
            for _, _, data, off in pieces(pc.utf8_lower(column.slice(at, to - at)), 1 << 62):
                yield at, to, data, off
        return
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        to = min(to, len(column))
        yield at, to, data[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """Apply ``work`` to each Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)
    return df.mapInArrow(run, schema)


def blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
