"""Packing token sequences in space-filling-curve order.

1. Each document is encoded, its tokens are hashed into a bag-of-buckets
   vector, and the vector is projected to ``DIMS`` numbers by fixed random
   signs.  Their Hilbert index is the document's place on the curve: close
   vectors get close places.  This table is written once.
2. It is range-sorted by (place, document), so neighbours on the curve lie
   in one partition and copies of one text spread over partitions.
3. Each partition fills sequences of ``length`` tokens, cutting documents
   freely.  What is left at its end is cut into sequences whose sizes are
   powers of two, which need no padding.

Null text counts as empty (its only token is the end token).  Repeated rows
and ties stand side by side, ordered by their tokens.  An empty table gives
an empty table.  Only the id and the text are read, so no other column can
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlewick.llm.tokens import encoder
from candlewick.llm.words import lean
from candlewick.session import save

LENGTH = 2048
END = 1
DIMS, BITS = 4, 10
BUCKETS, SEED = 256, 11


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates (Skilling's
    transform: undo the rotations from the top bit down, then Gray-decode)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ t) >> b) & 1)
    return out


@lru_cache(maxsize=1)
def _projection() -> tuple[np.ndarray, np.ndarray]:
    """Random signs by bucket and dimension, and the bucket of each token id."""
    rng = np.random.default_rng(SEED)
    return rng.choice([-1.0, 1.0], (BUCKETS, DIMS)), rng.integers(0, BUCKETS, 1 << 20)


def curve_place(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert index of each document's hashed token vector."""
    signs, bucket = _projection()
    size = np.array([len(x) for x in ids])
    flat = np.concatenate(ids).astype(np.int64)
    doc = np.repeat(np.arange(len(ids)), size)
    bag = np.sqrt(np.bincount(doc * BUCKETS + bucket[flat % len(bucket)], minlength=len(ids) * BUCKETS))
    bag = bag.reshape(-1, BUCKETS)
    bag /= np.maximum(np.sqrt((bag ** 2).sum(1, keepdims=True)), 1e-12)
    z = np.clip((bag @ signs + 1) / 2, 0, 1 - 1e-9)  # most of a unit vector's projections lie within +-1
    return hilbert_index((z * (1 << BITS)).astype(np.int64))


def tokenized(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(_place, _doc, _ids): ids as little-endian unsigned numbers of 2 bytes, or 4 for large vocabularies."""
    def encode(batches):
        enc = encoder(path, "words")
        kind = "<u2" if enc.size <= 1 << 16 else "<u4"
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [np.append(enc.ids(t or ""), end).astype(kind) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(curve_place(ids)), part.column(0), pa.array([x.tobytes() for x in ids], pa.binary())],
                    ["_place", "_doc", "_ids"])

    kind = docs.schema[doc].dataType.simpleString()
    return docs.select(doc, text).mapInArrow(lean(encode), f"_place long, _doc {kind}, _ids binary")


def _sequences(rows: Iterator[tuple[object, np.ndarray]], length: int, base: int) -> Iterator[list[tuple]]:
    """Pieces (doc, start, ids, doc_tokens, sequence, offset), a sequence at a time."""
    held: list[tuple] = []
    filled, sequence = 0, base
    for doc, ids in rows:
        at = 0
        while at < len(ids):
            take = min(length - filled, len(ids) - at)
            held.append((doc, at, ids[at:at + take], len(ids), sequence, filled))
            filled, at = filled + take, at + take
            if filled == length:
                yield held
                held, filled, sequence = [], 0, sequence + 1
    # the rest, in powers of two from the largest
    offset, room = 0, 0
    for doc, start, ids, tokens, _, _ in held:
        at = 0
        while at < len(ids):
            if not room:
                room, offset = 1 << (filled.bit_length() - 1), 0
                filled -= room
            take = min(room, len(ids) - at)
            yield [(doc, start + at, ids[at:at + take], tokens, sequence, offset)]
            at, offset, room = at + take, offset + take, room - take
            sequence += not room


def pack(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", length: int = LENGTH,
         end: int = END) -> DataFrame:
    """One row per piece: ``doc``, start, length, doc_tokens, sequence_id,
    offset, ids (binary, little-endian unsigned 32-bit)."""
    from pyspark import TaskContext

    table = save(tokenized(docs, path, doc, text, end), "packing").df
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = table.repartitionByRange(parts, "_place", "_doc").sortWithinPartitions("_place", "_doc", "_ids")

    def fill(batches):
        enc = encoder(path, "words")
        kind = "<u2" if enc.size <= 1 << 16 else "<u4"
        base = TaskContext.get().partitionId() << 33
        rows = ((d, np.frombuffer(x, kind)) for batch in batches
                for d, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
        out: list[tuple] = []

        def batch_of(out):
            cols = list(zip(*out, strict=True))
            ids = [x.astype("<u4").tobytes() for x in cols[2]]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], doc_type), *(pa.array(c, pa.int64()) for c in (cols[1], [len(x) // 4 for x in ids], *cols[3:])),
                 pa.array(ids, pa.binary())], [doc, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for pieces in _sequences(rows, length, base):
            out += pieces
            if len(out) >= 2000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    from pyspark.sql.pandas.types import to_arrow_type

    field = docs.schema[doc]
    doc_type = to_arrow_type(field.dataType)
    return ranged.mapInArrow(lean(fill), f"`{doc}` {field.dataType.simpleString()}, start long, length long, doc_tokens long, "
                                   "sequence_id long, offset long, ids binary")
