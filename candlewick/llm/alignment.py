"""Cross-tokenizer alignment by pointer jumping, with corpus-wide link counts.

Two tokenizers cut the same bytes.  Every token points to the farthest-right
token that overlaps it (of the other side, unless none ends later); doubling
the pointers (``p = p[p]``) until nothing changes leads each token to the last
one of its component, which labels its group.  A group ends where tokens of
both sides end.  All pairs of an A and a B token of one group are links.

1. ``aligned_blocks``: texts are tokenized once, some MB of text a row (a
   *block*; a longer text is a block of its own), and written: ids of both
   sides and the group ends.
2. A block also tells its distinct id pairs and how many of its documents
   hold each; they are dealt to shards by A id.  A shard's counts are one dense table, whose
   size the two vocabularies bound (``TABLE_BYTES``); blocks are summed in
   salted groups first, then the groups.  The best B ids of an A id are in
   one shard.
3. Every block's distinct pairs are looked up in the shards (whose tables are
   copied once for each salt), and the answers go back to their block, where
   documents sum them.

Pairs are counted by distinct ids of a group, so a group of many equal tokens
makes few; nothing is dropped, and no table of pairs is broadcast.

Null and empty texts, and texts whose tokens do not spell a space and the
text, have no tokens: zeros and an empty ``groups``.  Each row is a document:
repeated rows and null or equal keys count each for itself.  An empty table
gives an empty table.  Only the two named columns are read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.pieces import PieceEncoder, piece_encoder, spelled, spelling
from candlewick.llm.tokens import Encoder, _byte_of, encoder
from candlewick.llm.words import buffers, lean, slices, trim
from candlewick.session import save

#: Bytes of text of a block, about.
BLOCK_BYTES = 1 << 20
#: Bytes of a shard's dense table of counts, at most (8 for each A id and B id).
TABLE_BYTES = 64 << 20
#: Blocks that are summed, or looked up, in one group.
SALTED = 4_096
#: Pairs of tokens that are held at once.
PAIRS = 4_000_000


# ---- one block -----------------------------------------------------------

def pointers(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Pointer of every token (A's, then B's) to its farthest-right overlapping
    one, by the tokens' byte ends; of two that end together, B's."""
    n, size = len(a_end), int(a_end[-1]) + 1
    before = []
    for end in (a_end, b_end):      # how many tokens end before each byte
        mark = np.zeros(size, np.int32)
        mark[end] = 1
        before.append(np.cumsum(mark, dtype=np.int32) - mark)
    i = before[0][b_end]
    last = a_end[i] == b_end
    return np.concatenate([n + before[1][a_end], np.where(last, n + np.arange(len(b_end), dtype=np.int32), i)])


def terminals(pointer: np.ndarray) -> np.ndarray:
    """Where each chain of pointers ends, by doubling those not yet there."""
    pointer = pointer.copy()
    open_ = np.arange(len(pointer), dtype=np.int32)
    while len(open_):
        further = pointer[pointer[open_]]
        moved = further != pointer[open_]
        open_ = open_[moved]
        pointer[open_] = further[moved]
    return pointer


def groups_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each A and each B token, in the order of the bytes."""
    if not len(a_end):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = terminals(pointers(a_end, b_end))
    group = (np.cumsum(label == np.arange(len(label)), dtype=np.int32) - 1)[label].astype(np.int64)
    return group[:len(a_end)], group[len(a_end):]


@dataclass(frozen=True)
class Shards:
    """A ids dealt to shards; a pair's place in its shard's dense table."""

    a_ids: int
    b_ids: int

    @property
    def number(self) -> int:
        return max(1, -(-8 * self.a_ids * self.b_ids // TABLE_BYTES))

    @property
    def cells(self) -> int:
        return -(-self.a_ids // self.number) * self.b_ids

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shard and place as one sortable number."""
        a = a.astype(np.int64)
        return (a % self.number) * self.cells + a // self.number * self.b_ids + b


@dataclass
class Block:
    """Tokens of some documents: ids, group and document of each."""

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_doc: np.ndarray
    docs: int

    @classmethod
    def read(cls, row: dict, shards: Shards) -> Block:
        raw = {c: zstandard.decompress(row[c]) for c in ("_a", "_b", "_sizes")}
        width = "<u4" if len(raw["_sizes"]) > 2 * sum(row["_groups"]) else "u1"
        a, b, sizes = (np.frombuffer(raw[c], t) for c, t in (("_a", _kind(shards.a_ids)), ("_b", _kind(shards.b_ids)), ("_sizes", width)))
        a_size, b_size = sizes[0::2].astype(np.int64), sizes[1::2].astype(np.int64)
        group = np.arange(len(a_size))
        doc = np.repeat(np.arange(len(row["_groups"])), row["_groups"])
        return cls(a, b, np.repeat(group, a_size), np.repeat(group, b_size), doc, len(row["_groups"]))

    def sizes(self) -> tuple[np.ndarray, ...]:
        """(A tokens, B tokens, groups, links) of each document."""
        g = len(self.group_doc)
        na, nb = np.bincount(self.a_group, minlength=g), np.bincount(self.b_group, minlength=g)
        bounds = np.searchsorted(self.group_doc, np.arange(self.docs + 1))
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[bounds])
        return total(na), total(nb), np.diff(bounds), total(na * nb)

    def pairs(self, shards: Shards) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair's number, links) of the distinct pairs of each document."""
        g = len(self.group_doc)
        na, nb = np.bincount(self.a_group, minlength=g), np.bincount(self.b_group, minlength=g)
        one = (na == 1) & (nb == 1)         # most groups
        one_a, one_b = one[self.a_group], one[self.b_group]
        whole = shards.number * shards.cells
        key = np.sort(self.group_doc[one] * whole + shards.of(self.a[one_a], self.b[one_b]))
        first = np.flatnonzero(np.diff(key, prepend=-1))
        parts = [(*np.divmod(key[first], whole), np.diff(np.append(first, len(key))))]

        def distinct(group, ids):
            key, n = np.unique(group << 32 | ids, return_counts=True)
            return key >> 32, key & 0xFFFFFFFF, n

        ga, a, na = distinct(self.a_group[~one_a], self.a[~one_a].astype(np.int64))
        gb, b, nb = distinct(self.b_group[~one_b], self.b[~one_b].astype(np.int64))
        per_b, first_b = np.bincount(gb, minlength=g), np.searchsorted(gb, np.arange(g))
        sizes, at = np.cumsum(per_b[ga]), 0         # each distinct A id of a group meets the distinct B ids of it
        while at < len(ga):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PAIRS, "right")))
            many = per_b[ga[at:to]]
            left = np.repeat(np.arange(at, to), many)
            right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + first_b[ga[left]]
            parts.append(_summed(self.group_doc[ga[left]], shards.of(a[left], b[right]), na[left] * nb[right], shards))
            at = to
        return parts[0] if len(parts) == 1 else _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)), shards)

    def text(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        g = len(self.group_doc)
        before_a, before_b = (np.cumsum(np.bincount(x, minlength=g)) for x in (self.a_group, self.b_group))
        # A tokens of a group follow all of the groups before, its B tokens follow them
        at_a = np.arange(len(self.a)) + np.concatenate(([0], before_b))[self.a_group]
        at_b = np.arange(len(self.b)) + before_a[self.b_group] if g else at_a
        ids, key = (np.empty(len(at_a) + len(at_b), np.int64) for _ in range(2))
        ids[at_a], ids[at_b], key[at_a], key[at_b] = self.a, self.b, 2 * self.a_group, 2 * self.b_group + 1
        digits, shown = _decimals(len(str(int(ids.max(initial=0)))))
        cell, used = digits[ids], shown[ids]
        doc = self.group_doc[key >> 1]
        cell[:-1, -1] = np.where(key[1:] == key[:-1], ord(","), np.where((key[:-1] & 1) == 0, ord("|"), ord(";")))
        used[np.flatnonzero(np.diff(doc, append=-1)), -1] = False       # nothing follows a document's last token
        upto = np.concatenate(([0], np.cumsum(used.sum(axis=1))))
        ends = upto[np.searchsorted(doc, np.arange(self.docs + 1))]
        return pa.Array.from_buffers(pa.large_string(), self.docs, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(cell[used].tobytes())])


def _summed(doc: np.ndarray, pair: np.ndarray, n: np.ndarray, shards: Shards) -> tuple[np.ndarray, ...]:
    """Sums of equal (document, pair), in order; both fit one number."""
    key = doc * (shards.number * shards.cells) + pair
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return (*np.divmod(key[first], shards.number * shards.cells), np.add.reduceat(n[order], first) if len(first) else n)


def _kind(ids: int) -> str:
    return "<u2" if ids <= 1 << 16 else "<u4"


@lru_cache(maxsize=4)
def _decimals(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers of up to ``width`` places, right-aligned before a
    place for what follows, and which of the places each number uses."""
    n = np.arange(10 ** width)
    digits = np.stack([n // 10 ** k % 10 + ord("0") for k in range(width - 1, -1, -1)] + [0 * n], axis=1).astype(np.uint8)
    shown = np.stack([n >= (10 ** k if k else 0) for k in range(width - 1, -1, -1)] + [n >= 0], axis=1)
    return digits, shown


# ---- tokenizing ------------------------------------------------------------

class Sides:
    """Both tokenizers, with the bytes that each id stands for."""

    def __init__(self, path_a: str, path_b: str):
        self.a: Encoder = encoder(path_a, "spaced")
        self.b: PieceEncoder = piece_encoder(path_b)
        byte_of, vocab = _byte_of(), self.a.tokenizer.get_vocab(with_added_tokens=True)
        special = self.a.special
        self.a_bytes = [b""] * self.a.size
        for token, i in vocab.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(map(byte_of.__getitem__, token))
        self.a_spelling = spelling(self.a_bytes)

    def a_ids(self, text: str) -> list[int]:
        """Ids with the special tokens' strings as plain text."""
        if self.a.fast:
            return self.a.fast.encode_ordinary(text)
        self.a.tokenizer.encode_special_tokens = True
        try:
            return self.a.tokenizer.encode(text, add_special_tokens=False).ids
        finally:
            self.a.tokenizer.encode_special_tokens = False

    def both(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends) of either side; none where one of them does not spell a
        blank and the text."""
        plain = pc.fill_null(texts.cast(pa.large_string()), "")
        blank = pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(plain), 0), *(pa.scalar(x, pa.large_string()) for x in ("", " "))),
                                            plain, pa.scalar("", pa.large_string()))
        coded = [array("i", self.a_ids(x)) if x else b"" for x in blank.to_pylist()]
        a = np.frombuffer(b"".join(coded), np.int32)
        a_end = np.concatenate(([0], np.cumsum([len(x) for x in coded], dtype=np.int64)))
        b, b_end = self.b.batch(plain)
        data, offsets = buffers(blank)
        right = self._spell(a, a_end, self.a_spelling, data, offsets) & self._spell(b, b_end, self.b.spelling, data, offsets)
        return *_only(a, a_end, right), *_only(b, b_end, right)

    @staticmethod
    def _spell(ids: np.ndarray, ends: np.ndarray, table: tuple[np.ndarray, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether the ids of each text stand for its bytes."""
        spelt, size = spelled(ids, *table)
        upto = np.concatenate(([0], np.cumsum(size)))[ends]
        if np.array_equal(upto, offsets) and np.array_equal(spelt, data):
            return np.ones(len(ends) - 1, bool)
        return np.array([spelt[upto[i]:upto[i + 1]].tobytes() == data[offsets[i]:offsets[i + 1]].tobytes() for i in range(len(ends) - 1)], bool)


def _only(ids: np.ndarray, ends: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the ids of the texts that are not right."""
    size = np.diff(ends)
    return ids[np.repeat(right, size)], np.concatenate(([0], np.cumsum(np.where(right, size, 0))))


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, key: str, text: str, shards: Shards) -> DataFrame:
    """(_block, _keys, _groups, _a, _b, _sizes, _pairs): documents by blocks;
    number of groups of each, ids of both sides and sizes of the groups
    (packed and compressed); the block's distinct pairs by shard, as places in its table, and
    how many of the documents hold each."""
    def block(number: int, part: pa.RecordBatch) -> pa.RecordBatch:
        s = sides(path_a, path_b)
        a, upto, b, _ = s.both(part.column(1))
        ga, gb = groups_of(*(np.cumsum(spelt[1][x + 1] - spelt[1][x]) for x, spelt in ((a, s.a_spelling), (b, s.b.spelling))))
        n = int(ga[-1]) + 1 if len(ga) else 0
        sizes = np.stack([np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)], axis=1)
        # a document's groups: up to that of its last token
        per = np.diff(np.where(upto > 0, np.concatenate(([0], ga + 1))[upto], 0)).astype(np.int64)
        row = {"_groups": per.tolist()} | {c: zstandard.compress(_ints(x, t), 1) for c, x, t in (
            ("_a", a, _kind(shards.a_ids)), ("_b", b, _kind(shards.b_ids)), ("_sizes", sizes, "u1" if sizes.max(initial=0) < 256 else "<u4"))}
        place, held = np.unique(Block.read(row, shards).pairs(shards)[1], return_counts=True)
        cut = np.flatnonzero(np.diff(place // shards.cells, prepend=-1))
        ends = np.append(cut, len(place))
        pairs = [{"_s": int(place[x] // shards.cells), "_places": _ints(place[x:y] % shards.cells, "<u4"), "_n": _ints(held[x:y], "<i8")}
                 for x, y in zip(ends, ends[1:], strict=False)]
        kind = pa.list_(pa.struct([("_s", pa.int32()), ("_places", pa.binary()), ("_n", pa.binary())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([part.column(0)], pa.list_(part.column(0).type)), pa.array([per], pa.list_(pa.int64())),
             *(pa.array([row[c]], pa.binary()) for c in ("_a", "_b", "_sizes")), pa.array([pairs], kind)],
            ["_block", "_keys", "_groups", "_a", "_b", "_sizes", "_pairs"])

    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "_text", BLOCK_BYTES):
                yield block(number, part)
                number += 1
            trim()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        lean(body), f"_block long, _keys array<{kind}>, _groups array<long>, _a binary, _b binary, _sizes binary, "
                    "_pairs array<struct<_s: int, _places: binary, _n: binary>>")


# ---- counts over all documents ---------------------------------------------

def _ints(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


def _runs(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Consecutive rows with equal values of ``names``, one row at a time."""
    rows = (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))
    yield from groupby(rows, key=lambda r: tuple(r[n] for n in names))


def _summed_tables(rows: DataFrame, shards: Shards, *by: str) -> DataFrame:
    """Counts of each group ``by`` (shard first), by place."""
    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(shards.cells, np.int64)
        for names, run in _runs(batches, *by):
            table[:] = 0
            for row in run:
                table[np.frombuffer(row["_places"], "<u4")] += np.frombuffer(row["_n"], "<i8")    # places of a row are distinct
            place = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in names), pa.array([_ints(place, "<u4")], pa.binary()),
                                              pa.array([_ints(table[place], "<i8")], pa.binary())], [*by, "_places", "_n"])

    return (rows.select(*by, "_places", "_n").repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(lean(body), ", ".join(f"{x} int" for x in by) + ", _places binary, _n binary"))


def _answers(requests: DataFrame, tables: DataFrame, shards: Shards, salts: int) -> DataFrame:
    """(_block, _s, _found): for each requested pair twice its count, plus 1 if
    it is the highest of its A id."""
    def body(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(shards.cells, np.int64)
        for (s, _), run in _runs(batches, "_s", "_k"):
            for row in run:
                place = np.frombuffer(row["_places"], "<u4")
                if row["_block"] is None:       # the shard's counts come first
                    table[:] = 0
                    table[place] = np.frombuffer(row["_n"], "<i8")
                    highest = table.reshape(-1, shards.b_ids).max(axis=1)
                else:
                    n = table[place]
                    found = 2 * n + (n == highest[place // shards.b_ids])
                    yield pa.RecordBatch.from_arrays([pa.array([row["_block"]], pa.int64()), pa.array([s], pa.int32()),
                                                      pa.array([_ints(found, "<i8")], pa.binary())], ["_block", "_s", "_found"])

    copies = tables.select("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_k"), F.lit(None).cast("long").alias("_block"), "_places", "_n")
    both = copies.unionByName(requests.withColumn("_n", F.lit(None).cast("binary")))
    return (both.repartition("_s", "_k").sortWithinPartitions("_s", "_k", F.col("_block").asc_nulls_first())
            .mapInArrow(lean(body), "_block long, _s int, _found binary"))


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): tokens of
    both sides, groups and links of each document; how many links are of a
    pair with its A id's highest count; the sum of the links' counts; and the
    groups as ``a1,a2|b1;a3|b2,b3``."""
    both = sides(path_a, path_b)
    shards = Shards(both.a.size, both.b.size)
    blocks = save(aligned_blocks(docs, path_a, path_b, key, text, shards), "aligned-blocks").df
    salts = 1 + blocks.count() // SALTED
    requests = blocks.select("_block", F.pmod("_block", F.lit(salts)).cast("int").alias("_k"), F.inline("_pairs"))
    tables = save(_summed_tables(_summed_tables(requests, shards, "_s", "_k"), shards, "_s"), "alignment-counts").df
    answers = save(_answers(requests.drop("_n"), tables, shards, salts), "alignment-answers").df

    def body(left: pa.Table, right: pa.Table) -> pa.Table:
        """One block and its answers, at most one a shard."""
        left = left.combine_chunks()
        row = left.drop_columns(["_keys"]).to_pylist()[0]
        block = Block.read(row, shards)
        doc, pair, n = block.pairs(shards)
        _, at = np.unique(pair, return_inverse=True)
        parts = sorted(right.to_pylist(), key=lambda x: x["_s"])
        found = np.frombuffer(b"".join(x["_found"] for x in parts), "<i8")[at]
        n_best, total = np.zeros(block.docs, np.int64), np.zeros(block.docs, np.int64)
        np.add.at(n_best, doc, n * (found & 1))
        np.add.at(total, doc, n * (found >> 1))
        keys = left.column("_keys").chunk(0).flatten()
        columns = [keys, *(pa.array(x, pa.int64()) for x in (*block.sizes(), n_best, total)), block.text().cast(pa.string())]
        trim()
        return pa.table(columns, names=[key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    kind = docs.schema[key].dataType.simpleString()
    # block by block: a batch holds one
    return (blocks.drop("_pairs").groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(
        body, f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"))
