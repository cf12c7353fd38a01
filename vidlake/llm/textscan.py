"""Vectorised scanning of Arrow string columns inside Python workers.

Texts are read as UTF-8 bytes straight from the Arrow buffers, a few megabytes of whole documents at a
time, so memory in a worker is bounded by the chunk size or by one document, whichever is larger.  Words
are runs of bytes other than 0x20 and 0x09-0x0D, which are all ASCII, so splitting bytes equals splitting
code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240131)
_BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_CODE = _RANDOM.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM_CODE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what a worker builds from one stays small; Arrow's freed memory goes
    back to the system at the end, as an idle worker would keep it."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
    pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the public splitmix64 step)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1 + column.offset)[column.offset:].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


@dataclass
class Words:
    """Words of a run of documents.  ``first[d]:first[d+1]`` are the words of document d."""

    text: np.ndarray      # lower-cased (or raw) bytes of the chunk
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray     # per document, index of its first word; one more entry than documents

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word: sum of byte codes times place codes, mixed with the length."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        begin = self.starts[0]
        spans = np.diff(np.append(self.starts, len(self.text)))
        place = np.arange(len(self.text) - begin, dtype=np.int64) - np.repeat(self.starts - begin, spans)
        body = self.text[begin:]
        codes = _BYTE_CODE[body]
        codes *= _PLACE_CODE[place & 4095]
        longest = int(spans.max())
        if longest > 4096:
            codes *= (2 * (place >> 12) + 1).astype(np.uint64)
        codes[_IS_SPACE[body]] = 0
        total = np.add.reduceat(codes, self.starts - begin)
        return mix64(total + (self.ends - self.starts).astype(np.uint64) * _GRAM_CODE[63])

    def strings(self, which: np.ndarray) -> list[str]:
        raw = self.text.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(self.starts[which], self.ends[which])]


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    text = _LOWER[data] if lower else data
    space = _IS_SPACE[text]
    filled = offsets[:-1][np.diff(offsets) > 0]
    before = np.empty(len(text), bool)
    after = np.empty(len(text), bool)
    if len(text):
        before[0], after[-1] = True, True
        before[1:], after[:-1] = space[:-1], space[1:]
        before[filled] = True
        after[filled[1:] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(text, starts, ends, np.searchsorted(starts, offsets))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets) of consecutive whole documents of about ``limit`` bytes in all."""
    data, offsets = utf8_buffers(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash per k-word shingle, first shingle of each document): a document with 1..k-1 words has its
    whole sequence as one shingle, one without words has none."""
    h = words.hashes()
    count = np.diff(words.first)
    per_doc = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    if not first[-1]:
        return np.zeros(0, np.uint64), first
    at = np.repeat(words.first[:-1] - first[:-1], per_doc) + np.arange(first[-1])
    left = np.repeat(np.minimum(count, k), per_doc)
    total = np.zeros(first[-1], np.uint64)
    for j in range(k):
        take = at + j
        if j:
            short = left <= j
            take = np.where(short, 0, take)
            part = h[take] * _GRAM_CODE[j]
            part[short] = 0
        else:
            part = h[take] * _GRAM_CODE[0]
        total += part
    return mix64(total + left.astype(np.uint64) * _GRAM_CODE[62]), first
