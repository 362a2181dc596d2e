"""SentencePiece encoding and decoding of merge-type vocabularies.

A text (white space as U+2581, one more in front) is cut into characters.
An agenda holds every pair of neighbouring symbols whose joined text is a
piece, best score first and leftmost among equals; the top pair is joined,
its new neighbours enter, and pairs whose symbols have changed since are
passed over.  Characters without a piece become byte pieces.

Two neighbouring bytes that stand in no piece side by side are never joined
(white space behind a word, punctuation behind a letter), so texts are cut
between them.  Of a slice of an Arrow batch each distinct chunk goes through
its agenda once: short chunks side by side, a row of a matrix each, of which
every step joins the best pair; longer ones, and those with characters
outside the vocabulary, one by one with a heap.  The ids of a slice's
distinct chunks are then held against the library's own; a difference ends
the job.

Null text counts as empty and has the end id only.  Empty tables give empty
tables, repeated rows their ids each; a text of any length is encoded whole,
in time that grows with its length times the logarithm of its longest
unbroken run.  The output column replaces one of the same name.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.words import buffers, lean, slices, trim

SPACE = "▁"
#: Bytes of text whose distinct chunks are encoded together.
SLICE_BYTES = 1 << 20
#: Characters of a matrix row, at most, by steps; rows of a matrix.
WIDTHS, ROWS = (4, 8, 16, 32, 64), 16_384
#: Chunks that the library gets as one text, with a null character between
#: them, and checked ones that a worker remembers.
GROUP, CHECKED = 500, 200_000
_NONE = np.iinfo(np.int32).max


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    """A replacement character for each byte that is no character."""
    return "�", error.start + 1


codecs.register_error("candlewick-bytes", _one_by_one)


def distinct_chunks(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct chunks, number of each chunk among them, each text's first
    chunk with the total at the end); chunks begin where ``cut`` says and at
    the texts' starts."""
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    start = np.flatnonzero(cut)
    ends = np.append(start, len(data)).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    return chunks.dictionary, chunks.indices.to_numpy(), np.searchsorted(start, offsets)


def expand(ids: np.ndarray, ends: np.ndarray, number: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, and their ends, from the ids of the distinct chunks."""
    size = np.diff(ends)[number]
    upto = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(upto[-1]) + np.repeat(ends[:-1][number] - upto[:-1], size)
    return ids[at], upto[first]


class _Joins:
    """Pairs of symbols to the piece they join to: open addressing in arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int], symbols: int):
        self.symbols, self.bits = symbols, max(8, (8 * len(pairs)).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.full(1 << self.bits, -1, np.int32)
        left = np.array([x * symbols + y for x, y in pairs], np.int64)
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot, self.probes = self._slot(left), 0
        while len(left):        # whoever finds a free slot takes it, the others try the next one
            free = self.key[slot] == -1
            self.key[slot[free]], self.value[slot[free]] = left[free], value[free]
            lost = self.key[slot] != left
            left, value, slot = left[lost], value[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Joined piece of each pair, or -1."""
        key = x.astype(np.int64) * self.symbols + y
        slot = self._slot(key)
        found = self.key[slot]
        out = np.where(found == key, self.value[slot], -1)
        open_ = np.flatnonzero((found != key) & (found != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.key[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.value[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class PieceEncoder:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        names = [sp.id_to_piece(i) for i in ids]
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        if any(sp.encode(x)[-1:] != sp.encode(f"{x}{x}")[-1:] or sp.decode(sp.encode(x)) != x for x in (" a", "ﬁ a", "  a ")):
            raise ValueError("a model that normalises its text is not supported")
        self.score = {names[i]: sp.get_score(i) for i in ids if i not in special}
        self.id = {names[i]: i for i in ids if i not in special}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, self.bytes)):
            raise ValueError("a vocabulary without byte pieces is not supported")
        self.end, self.size = sp.eos_id(), len(names)
        byte_of = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.control = frozenset(i for i in special if sp.is_control(i))
        self.raw = [byte_of.get(i) or (b"" if i in self.control else names[i].replace(SPACE, " ").encode()) for i in ids]
        self.surface = list(self.raw)
        self.surface[sp.unk_id()] = " ⁇ ".encode()     # fixed value
        self.opens = frozenset(i for x, i in self.id.items() if x.startswith(SPACE))
        if any("\0" in x for x in self.id) or SPACE not in self.id:
            raise ValueError("a vocabulary of this kind is not supported")
        self.checked: set[str] = set()
        self._tables(names)

    def _tables(self, names: list[str]) -> None:
        # characters inside pieces that are no pieces themselves get numbers behind the ids
        number = dict(self.id)
        for x in self.id:
            for c in x:
                number.setdefault(c, len(names) + len(number))
        self.symbols = max(number.values()) + 2
        self.nothing = self.symbols - 1
        self.joins = _Joins({(number[x[:k]], number[x[k:]]): i for x, i in self.id.items()
                             for k in range(1, len(x)) if x[:k] in number and x[k:] in number}, self.symbols)
        score = np.array([self.score.get(x, -np.inf) for x in names])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.spelling = spelling(self.raw)
        self.opening = np.zeros(len(names), bool)
        self.opening[[*self.opens]] = True
        self.symbol = np.full(0x110000, -1, np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i if i < len(names) else -1
        self.symbol[0x20] = self.id[SPACE]
        self.inside = np.zeros((256, 256), bool)
        for x in self.id:
            raw = np.frombuffer(x.replace(SPACE, " ").encode(), np.uint8)
            self.inside[raw[:-1], raw[1:]] = True

    # ---- encoding ---------------------------------------------------

    def agenda(self, chunk: str) -> list[int]:
        symbols: list[str] = list(chunk)
        score, n = self.score, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = []
        for i in range(n - 1):
            s = score.get(symbols[i] + symbols[i + 1])
            if s is not None:
                waiting.append((-s, i, i + 1, symbols[i] + symbols[i + 1]))
        heapify(waiting)
        while waiting:
            _, i, j, joined = heappop(waiting)
            # a symbol that was joined away is empty, one that has grown is longer
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(joined):
                continue
            symbols[i], symbols[j] = joined, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                s = score.get(joined + symbols[k])
                if s is not None:
                    heappush(waiting, (-s, i, k, joined + symbols[k]))
            h = before[i]
            if h >= 0:
                s = score.get(symbols[h] + joined)
                if s is not None:
                    heappush(waiting, (-s, h, i, symbols[h] + joined))
        out: list[int] = []
        for x in symbols:
            if x:
                i = self.id.get(x)
                out += [i] if i is not None else [self.bytes[b] for b in x.encode()]
        return out

    def agendas(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids of each): an agenda for each row of
        symbols, of which the first ``length`` count."""
        n, width = symbols.shape
        joined = np.full((n, width), -1, np.int32)
        joined[:, :-1] = self.joins(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, width - 1)
        rank = np.where(joined >= 0, self.rank[joined], _NONE)
        after, before = (np.tile(np.arange(width, dtype=np.int32) + x, (n, 1)) for x in (1, -1))
        alive = np.arange(width) < length[:, None]
        rows = np.arange(n)
        while len(rows):
            waiting = rank[rows]
            i = waiting.argmin(axis=1)              # the best, leftmost among equals
            go = waiting[np.arange(len(rows)), i] < _NONE
            rows, i = rows[go], i[go]
            j = after[rows, i]
            new = joined[rows, i]
            symbols[rows, i] = new
            alive[rows, j] = False
            rank[rows, j] = _NONE
            k = after[rows, j]
            after[rows, i] = k
            more = k < width
            before[rows[more], k[more]] = i[more]
            right = self.joins(new, np.where(more, symbols[rows, np.minimum(k, width - 1)], self.nothing))
            joined[rows, i], rank[rows, i] = right, np.where(right >= 0, self.rank[right], _NONE)
            h = before[rows, i]
            more = h >= 0
            r, h = rows[more], h[more]
            left = self.joins(symbols[r, h], new[more])
            joined[r, h], rank[r, h] = left, np.where(left >= 0, self.rank[left], _NONE)
        return symbols[alive], alive.sum(axis=1)

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of distinct chunks (white space as a blank)."""
        data, offsets = buffers(chunks.cast(pa.large_string()))
        length = np.diff(np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets])
        symbol = self.symbol[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        first = np.cumsum(length) - length
        plain = np.ones(len(length), bool)
        if len(length):
            plain = np.minimum.reduceat(symbol, first) >= 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero(plain & (length > low) & (length <= width))
            low = width
            for part in (rows[i:i + ROWS] for i in range(0, len(rows), ROWS)):
                at = np.minimum(first[part][:, None] + np.arange(width), len(symbol) - 1)
                symbols = np.where(np.arange(width) < length[part][:, None], symbol[at], self.nothing).astype(np.int32)
                found.append((part, *self.agendas(symbols, length[part])))
        rest = np.flatnonzero(~plain | (length > low))
        if len(rest):
            ids = [self.agenda(x.as_py().decode().replace(" ", SPACE)) for x in chunks.take(pa.array(rest))]
            found.append((rest, np.array([i for x in ids for i in x], np.int32), np.array(list(map(len, ids)))))
        size = np.zeros(len(length), np.int64)
        for part, _, n in found:
            size[part] = n
        ends = np.concatenate(([0], np.cumsum(size)))
        out = np.empty(ends[-1], np.int32)
        for part, ids, n in found:
            out[np.arange(len(ids)) + np.repeat(ends[:-1][part] - (np.cumsum(n) - n), n)] = ids
        return out, ends

    def check(self, chunks: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """Hold the ids of chunks not met before against the library's."""
        names = chunks.cast(pa.large_string()).to_pylist()
        new = [k for k, x in enumerate(names) if x not in self.checked and x != "\0"]
        if len(self.checked) > CHECKED:
            self.checked.clear()
        self.checked.update(names)
        groups = [new[i:i + GROUP] for i in range(0, len(new), GROUP)]
        theirs = self.library.encode(["\0" + "\0".join([names[k] for k in g]) for g in groups], num_threads=1)
        size = 1 + np.diff(ends)[new]
        mine, at = np.full(int(size.sum()), self.bytes[0], np.int32), np.cumsum(size) - size
        own = np.ones(len(mine), bool)
        own[at] = False
        mine[own] = expand(ids, ends, np.array(new, np.int64), np.array([0]))[0]
        mine, cut = mine.tolist(), [*at[::GROUP].tolist(), len(mine)]
        for k, got in enumerate(theirs):
            if got[1:] != mine[cut[k]:cut[k + 1]] or got[0] != self.id[SPACE]:
                raise RuntimeError(f"ids differ from the library's among {names[groups[k][0]][:40]!r} and the chunks behind it")

    def prepared(self, texts: pa.Array) -> pa.Array:
        """Texts as they are cut: U+2581 as a blank, one more in front."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, SPACE, " ")
        lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        return pc.binary_join_element_wise(lead, texts, pa.scalar("", pa.large_string()))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of whole texts, without end ids; checked."""
        data, offsets = buffers(self.prepared(texts))
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.inside[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        chunks, number, first = distinct_chunks(data, offsets, cut)
        ids, ends = self.chunk_ids(chunks)
        self.check(chunks, ids, ends)
        return expand(ids, ends, number, first)

    # ---- decoding ---------------------------------------------------

    def text(self, ids: list[int]) -> str:
        """The library's text of any ids."""
        first = next((i for i in ids if i not in self.control), None)
        surface, inner = self.surface, ids[:-1] if ids and ids[-1] in self.control else ids
        if self.control.isdisjoint(inner):
            raw = b"".join(map(surface.__getitem__, inner))
        else:       # a control id ends a run of byte pieces
            parts, at = [], 0
            for k, i in enumerate([*inner, self.end]):
                if i in self.control:
                    parts.append(b"".join(map(surface.__getitem__, inner[at:k])).decode("utf-8", "candlewick-bytes"))
                    at = k + 1
            raw = "".join(parts).encode()
        return raw[first in self.opens:].decode("utf-8", "candlewick-bytes")


    def texts(self, ids: pa.Array) -> pa.Array:
        """The library's text of each list of ids; null for null."""
        ids = ids.cast(pa.large_list(pa.int32()))
        flat, lists = ids.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        ends = np.concatenate(([0], np.cumsum(lists)))
        odd_id = np.zeros(self.size, bool)
        odd_id[[*self.control, self.library.unk_id(), *self.bytes[128:]]] = True
        last = np.zeros(len(flat), bool)
        last[ends[1:][lists > 0] - 1] = True
        wrong = odd_id[flat] & ~(last & np.isin(flat, [*self.control]))
        odd = np.diff(np.concatenate(([0], np.cumsum(wrong)))[ends]) > 0
        raw, sizes = spelled(flat, *self.spelling)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        begin, end = upto[ends[:-1]], upto[ends[1:]]
        opens = np.zeros(len(lists), bool)
        opens[lists > 0] = self.opening[flat[ends[:-1][lists > 0]]]
        keep = np.ones(len(raw), bool)
        keep[begin[opens]] = False
        out = np.concatenate(([0], np.cumsum(end - begin - opens)))
        plain = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(out.astype(np.int64)), pa.py_buffer(raw[keep].tobytes())])
        if not odd.any() and not ids.null_count:
            return plain
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        return pa.array([(self.text(flat[ends[i]:ends[i + 1]].tolist()) if odd[i] else plain[i].as_py()) if known[i] else None
                         for i in range(len(lists))], pa.large_string())


def spelling(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all ids, and where those of each begin."""
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum(list(map(len, raw)))))


def spelled(ids: np.ndarray, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the ids stand for, and how many each."""
    size = (first[1:] - first[:-1])[ids]
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[ids] - (ends - size), size)], size


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def piece_encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``out``: array<int>, the ids of the whole text and the
    end id; with ``decoded``, the text of these ids in a column of that name."""
    new = {out: "array<int>"} | ({decoded: "string"} if decoded else {})
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], F.col(f"`{text}`").alias("_piece_text"))

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = piece_encoder(path)
        for batch in batches:
            for part in slices(batch, "_piece_text", SLICE_BYTES):
                ids, ends = enc.batch(part.column(part.num_columns - 1))
                ids = np.insert(ids, ends[1:], enc.end)
                lists = pa.ListArray.from_arrays(pa.array((ends + np.arange(len(ends))).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, *([enc.texts(lists).cast(pa.string())] if decoded else [])],
                                                 [*part.schema.names[:-1], *new])
            trim()

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    coded = rows.mapInArrow(lean(body), ", ".join([*([kept] if kept else []), *(f"`{c}` {k}" for c, k in new.items())]))
    return coded.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*docs.columns, *new])])


def piece_decode(path: str, ids: Column | str) -> Column:
    """The text of an array of ids; null for null."""
    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        return piece_encoder(path).texts(column).cast(pa.string())

    return decode(ids)
