"""Words of a batch of texts as numpy arrays.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  These are
all ASCII, so a byte-wise cut is right for UTF-8.  Everything here works on
the Arrow buffers of one batch, without a Python loop over words.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64


def lean(body: Callable) -> Callable:
    """A mapInArrow body that hands its worker's memory back at the end: a
    worker waits for its next task with what allocators have kept, beside an
    executor that may just then need it."""
    def run(batches):
        try:
            yield from body(batches)
        finally:
            trim()

    return run


def trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)

_BASE = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Bytes of text that one slice of a batch holds (one longer text is a slice of its own).
SLICE_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * _M1
    x = x ^ (x >> U64(27))
    x = x * _M2
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


@dataclass
class Words:
    """``start``/``end``: byte offsets in ``data``; ``first``: index of each
    text's first word, with the total at the end; ``hash``: one per word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word lies in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """All words of the texts; ``lower`` folds A-Z (only) to a-z first."""
    data, offsets = buffers(texts)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    n = len(data)
    solid = np.ones(n + 2, bool)
    solid[0] = solid[-1] = False
    solid[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    body = solid[1:-1]
    begins, ends = body & ~solid[:-2], body & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner] = body[inner]          # a text ends a word even without white space
    ends[inner - 1] = body[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, first, _hashes(data, body, start, end))


def _hashes(data, body, start, end) -> np.ndarray:
    if not len(start):
        return np.zeros(0, U64)
    size = end - start
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    within = np.arange(int(size.sum())) - np.repeat(at, size)
    value = (data[body].astype(U64) + U64(1)) * powers(_BASE, int(size.max()))[within]
    return mix(np.add.reduceat(value, at) + size.astype(U64) * _M2)


def rolling(word_hash: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``k`` words from each position of one stream of words (the
    caller drops windows that cross texts); empty when there are fewer."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    coef = powers(_M1 + U64(2 * salt), k)
    for i in range(k):
        out += word_hash[i:i + n] * coef[i]
    return mix(out + U64(k))


def windows(words: Words, k: int) -> np.ndarray:
    """Starts of the ``k``-word windows that lie in one text, as word indices."""
    n = int(words.first[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    last = np.repeat(words.first[1:], words.counts)[:n]
    at = np.arange(n)
    return at[at + k <= last]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``size`` bytes of text each."""
    col = batch.column(batch.schema.get_field_index(column))
    if not batch.num_rows:
        return
    _, offsets = buffers(col)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
