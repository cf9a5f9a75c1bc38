"""Words of Arrow text columns as NumPy arrays, many texts at a time.

Whole batches are split into words on their UTF-8 bytes: a 256-entry table says which bytes belong
to words, another folds case, and all words of a batch are hashed by differences of one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.ones(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False          # [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, dtype=bool)
for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[low:high] = True                          # after folding: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
SAME = np.arange(256, dtype=np.uint8)
FOLD = SAME.copy()
FOLD[0x41:0x5B] += 0x20                             # A-Z only

_PIECE = 1 << 20
_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)               # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _PIECE), _powers(_INVERSE, _PIECE)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, others spread over all bits."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """All words of some texts, in order. Word k is ``data[start[k]:end[k]]``."""

    data: np.ndarray      # bytes of all texts, case folded
    texts: np.ndarray     # byte offset of each text, one more at the end
    first: np.ndarray     # index of each text's first word, one more at the end
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[low:high] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - low


def split_words(column: pa.Array, inside: np.ndarray = SPACE, fold: np.ndarray = SAME) -> Words:
    data, texts = text_bytes(column)
    data = data if fold is SAME else fold[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, texts, np.zeros(len(texts), np.int64), none, none)
    word = inside[data]
    begins = texts[:-1][texts[:-1] < n]
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[begins] = word[begins]
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    last = begins[begins > 0] - 1
    stop[last] = word[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return Words(data, texts, np.searchsorted(starts, texts), starts, ends)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span (ordered, not overlapping), independent of its place."""
    out = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):
        base = int(start[k])
        # As many spans as fit a piece, one at least.
        j = max(k + 1, int(np.searchsorted(end, base + _PIECE, side="right")))
        size = int(end[j - 1]) - base
        up, down = (_UP, _DOWN) if size <= _PIECE else (_powers(_BASE, size), _powers(_INVERSE, size))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[base:base + size]] * up[:size], out=sums[1:])
        s, e = start[k:j] - base, end[k:j] - base
        out[k:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        k = j
    return out


def span_strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as an Arrow string column; they must hold whole UTF-8 characters."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    place = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[place]))
    ).cast(pa.string())


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ..., then the same for the next range."""
    if not len(start):
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(ends[-1]) + np.repeat(start - (ends - length), length)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        k = 0
        while k < batch.num_rows:
            j = int(np.searchsorted(offsets, offsets[k] + limit, side="right")) - 1
            j = min(batch.num_rows, max(k + 1, j))
            yield batch.slice(k, j - k)
            k = j
