"""Windows of words, bucketed by minimiser.

A window's minimiser is the smallest of the hashes of its ``p``-word grams
(the first of equal ones).  Equal windows have equal minimisers at equal
offsets, and neighbouring windows mostly share theirs, so a text falls into
short chains of consecutive windows with one minimiser each: about
``2 / (k - p + 2)`` chains per word.  Dealing chains by their minimiser
brings all equal windows together with one small row per chain.  The windows
of a very common gram are dealt one by one, by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.words import U64, Words, lean, mix, rolling, slices, windows, words_of
from candlewick.session import save

GRAM = 8
_PLACE_BITS = 28        # words of one slice or text that fit a place
_PLACE = U64((1 << _PLACE_BITS) - 1)
#: Bytes of a window's hash that travel; its bucket adds the 64 bits of the minimiser.
HASH_BYTES = 7
_HASH = U64((1 << (8 * HASH_BYTES)) - 1)
#: Rows that a task compares at a time; a bucket is never split.
BLOCK = 200_000
#: A bucket with more chains than this (and than a ``MAX_HOT``th of all) is dealt by window.
HOT, MAX_HOT = 200_000, 100_000
#: Every so manieth document, by hash, tells which buckets are so large.
TOLD_BY = 32
#: Chains that a map task remembers as met before.
SEEN = 200_000
#: ``_n``: of a chain with hashes 0, or MANY if the map task has met it twice; else, without
#: hashes, the number of windows of a chain that is settled: repeated, and not its first place.
CHAIN = "_m long, _k1 long, _k2 int, _at int, _n int, _w binary"
MANY = -1


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Add (_k1, _k2), which tell rows with different key or text apart; rows
    that agree in both need no telling apart, as they get equal answers."""
    kind = docs.schema[key].dataType
    own = F.col(key).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(key)
    body = F.coalesce(F.col(text), F.lit(""))
    missing = F.col(key).isNull()
    return docs.withColumns({"_k1": F.when(missing, F.xxhash64(body)).otherwise(own), "_k2": F.hash(body)})


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values, by doubling."""
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if w > span else x


def chains(words: Words, k: int, p: int = GRAM) -> tuple[np.ndarray, ...]:
    """(minimiser, first window, number of windows, window hashes) of each
    chain; a window is named by the index of its first word."""
    at = windows(words, k)
    if not len(at):
        return np.zeros(0, U64), at, at, np.zeros(0, U64)
    gram = rolling(words.hash, p)
    place = (gram & ~_PLACE) | np.arange(len(gram), dtype=U64)
    low = (_sliding_min(place, k - p + 1)[at] & _PLACE).astype(np.int64)
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(at) != 1) | (np.diff(low) != 0)
    first = np.flatnonzero(cut)
    count = np.diff(np.append(first, len(at)))
    return gram[low[first]], at[first], count, rolling(words.hash, k, salt=1)[at] & _HASH


def _one_by_one(common: np.ndarray, m: np.ndarray, at: np.ndarray, count: np.ndarray, hashes: np.ndarray):
    """Chains with those of the common minimisers cut into single windows,
    each in a bucket named by minimiser and window."""
    times = np.where(common, count, 1)
    chain = np.repeat(np.arange(len(m)), times)
    nth = np.arange(len(chain)) - np.repeat(np.cumsum(times) - times, times)
    single = common[chain]
    own = (np.cumsum(count) - count)[chain] + nth
    return (np.where(single, mix(m[chain] ^ mix(hashes[own])), m[chain]), at[chain] + np.where(single, nth, 0),
            np.where(single, 1, count[chain]))


class _Combiner:
    """Map-side combine: of equal chains that one task meets, only the one
    at the smallest place (document, word) is sent, marked MANY; the others
    are settled on the spot.  A passage that a third of all texts share so
    costs its bucket one row per map task."""

    def __init__(self, same_place: bool):
        self.same_place = same_place
        self.seen: dict[int, tuple[int, int, int]] = {}

    def settle(self, digest: np.ndarray, places: np.ndarray) -> np.ndarray:
        """``_n`` as 0, MANY, 1 (settled) or 2 (the very place met before,
        to be left out) for chains in order of place."""
        out = np.zeros(len(digest), np.int64)
        _, first, inverse, count = np.unique(digest, return_index=True, return_inverse=True, return_counts=True)
        out[count[inverse] > 1] = 1
        out[first[count > 1]] = MANY
        known = np.isin(digest, np.fromiter(self.seen, U64, len(self.seen)))
        for i in np.flatnonzero((out == MANY) | (known & (out == 0))):
            d, place = int(digest[i]), tuple(places[:, i].tolist())
            if d in self.seen and self.seen[d] <= place:
                out[i] = 1 if self.same_place or self.seen[d] != place else 2
            else:
                out[i] = MANY
                if len(self.seen) < SEEN:
                    self.seen[d] = place
        return out


def hot_grams(docs: DataFrame, text: str, k: int) -> np.ndarray:
    """Minimisers of large buckets, sorted.  Like the bounds of a range
    partitioning these come from a sample: they say how rows are dealt, and
    no result depends on them.  At most ``2 * MAX_HOT`` numbers."""
    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays([pa.array(chains(words_of(part.column(0)), k)[0].view(np.int64))], ["_m"])

    told = docs.where(F.pmod(F.xxhash64("_k1", "_k2"), F.lit(TOLD_BY)) == 0).select(F.col(text).alias("_text"))
    counts = save(told.mapInArrow(lean(grams), "_m long").groupBy("_m").count(), "grams")
    total = counts.df.agg(F.sum("count")).first()[0] or 0
    found = counts.df.where(F.col("count") > max(HOT // TOLD_BY, total // MAX_HOT)).select("_m").collect()
    counts.drop()
    return np.sort(np.array([r["_m"] for r in found], np.int64).view(U64))


def chain_rows(docs: DataFrame, text: str, k: int, same_place: bool) -> DataFrame:
    """Rows (``CHAIN``) of the keyed documents: minimiser, document, first
    window's word in the text, packed window hashes.  ``same_place``: whether
    rows that agree in id and text count as different places."""
    hot = hot_grams(docs, text, k)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = _Combiner(same_place)
        for batch in batches:
            for part in slices(batch, "_text"):
                yield from one(part, combiner)

    def one(part: pa.RecordBatch, combiner: _Combiner) -> Iterator[pa.RecordBatch]:
        words = words_of(part.column(2))
        m, at, count, hashes = chains(words, k)
        if not len(m):
            return
        if len(hot) and (common := np.isin(m, hot)).any():
            m, at, count = _one_by_one(common, m, at, count, hashes)
        row = np.searchsorted(words.first, at, "right") - 1
        k1, k2 = (part.column(i).to_numpy()[row] for i in (0, 1))
        start = at - words.first[row]
        first = np.concatenate(([0], np.cumsum(count)))
        nth = np.arange(len(hashes)) - np.repeat(first[:-1], count)
        digest = mix(m + np.add.reduceat(mix(hashes + nth.astype(U64) * U64(0xD6E8FEB86659FD93)), first[:-1]))
        order = np.lexsort((start, k2, k1))
        if not same_place:      # equal rows are one document
            o = order
            new = np.ones(len(o), bool)
            new[1:] = (np.diff(k1[o]) != 0) | (np.diff(k2[o]) != 0) | (np.diff(start[o]) != 0)
            order = o[new]
        n = np.zeros(len(m), np.int64)
        n[order] = combiner.settle(digest[order], np.array([k1[order], k2[order], start[order]]))
        keep = np.zeros(len(m), bool)
        keep[order] = n[order] != 2
        settled = n == 1
        sent = keep & ~settled
        live = np.repeat(sent, count)
        packed = hashes[live].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
        ends = np.concatenate(([0], np.cumsum(np.where(sent, count, 0)))).astype(np.int32) * HASH_BYTES
        binary = pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
        # settled rows only pass through, so they are dealt evenly
        to = np.where(settled, mix(k1.view(U64) + start.astype(U64)), m)
        rows = pa.RecordBatch.from_arrays(
            [pa.array(to.view(np.int64)), pa.array(k1), pa.array(k2), pa.array(start.astype(np.int32)),
             pa.array(np.where(settled, count, n).astype(np.int32)), binary], ["_m", "_k1", "_k2", "_at", "_n", "_w"])
        yield rows.filter(pa.array(keep))

    return docs.select("_k1", "_k2", F.col(text).alias("_text")).mapInArrow(lean(cut), CHAIN)


def buckets(batches: Iterable[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.Table]:
    """Whole buckets, about ``block`` rows at a time, of rows sorted by ``_m``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < block:
            continue
        table = pa.Table.from_batches(held)
        m = table.column(0).to_numpy()
        end = int(np.searchsorted(m, m[-1]))
        if end:
            yield table.slice(0, end)
            held = table.slice(end).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, window's word, hash over bucket and window) of every window."""
    column = table.column("_w").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0]:offsets[-1]].reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :HASH_BYTES] = raw
    count = np.diff(offsets) // HASH_BYTES
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    m = table.column("_m").to_numpy().view(U64)[row]
    # the 7 bytes fill the low part, the minimiser is spread over all
    key = wide.view("<u8").reshape(-1) ^ (m * U64(0x9E3779B97F4A7C15))
    return row, table.column("_at").to_numpy().astype(np.int64)[row] + nth, key


PIECE = "_k1 long, _k2 int, _at int, _n int, _first boolean"


def pieces(table: pa.Table, row: np.ndarray, at: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """Runs of consecutive windows of one chain that are all first places of
    their words, or all not."""
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(row) != 0) | (np.diff(at) != 1) | (first[1:] != first[:-1])
    begin = np.flatnonzero(cut)
    own = pa.array(row[begin])
    return pa.RecordBatch.from_arrays(
        [pa.array(table.column(c).to_numpy()[row[begin]]) for c in ("_k1", "_k2")]
        + [pa.array(at[begin].astype(np.int32)), pa.array(np.diff(np.append(begin, len(at))).astype(np.int32)),
           pa.array(first[begin])], ["_k1", "_k2", "_at", "_n", "_first"]) if len(own) else _none()


def _none() -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([], pa.schema([("_k1", pa.int64()), ("_k2", pa.int32()), ("_at", pa.int32()),
                                                     ("_n", pa.int32()), ("_first", pa.bool_())]))


def settled(table: pa.Table) -> pa.RecordBatch:
    """Pieces of the rows that the map side has settled."""
    hit = table.filter(pa.array(table.column("_n").to_numpy() > 0)).combine_chunks()
    if not hit.num_rows:
        return _none()
    cols = [hit.column(c).combine_chunks() for c in ("_k1", "_k2", "_at", "_n")]
    cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
    return pa.RecordBatch.from_arrays([*cols, pa.array(np.zeros(len(hit), bool))], ["_k1", "_k2", "_at", "_n", "_first"])


def cover(n_words: int, k: int, at: list[int], n: list[int]) -> np.ndarray:
    """Which words the windows cover.  Pieces of a text must lie in it."""
    step = np.zeros(n_words + 1, np.int64)
    begin, end = np.array(at, np.int64), np.array(at, np.int64) + np.array(n, np.int64) + k - 1
    if len(begin) and (begin.min() < 0 or end.max() > n_words):
        raise ValueError("a piece leaves its text")
    np.add.at(step, begin, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0
