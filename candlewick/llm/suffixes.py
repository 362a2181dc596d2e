"""Suffix-array dedup of long repeated passages.

A sparse suffix array: of all suffixes of all texts only those are retained
that start at a minimiser of some window of ``min_words`` words, about one
word in twenty, chosen by content alone, so that equal passages retain
suffixes at equal places.

1. Suffixes are dealt by their first 8 words (``minimizers.py``), so every
   bucket is one run of the suffix array.
2. In a bucket the suffixes are sorted and each is compared with its
   neighbours.  A match is extended to the left and to the right, a word at
   a time: at each shift the window of ``min_words`` words around the suffix
   start is sorted with the others of that shift, and equal neighbours match.
   This finds every pair of equal windows, also where the longest match to
   the left and the longest to the right are with different texts.
3. The smallest place (document id, word) of equal windows is their first
   occurrence and stays; words that another occurrence covers are removed.

Places are compared by document id, so which copy stays does not depend on
the partitioning.  Null text has no words.  Rows that agree in id and text
are one document: they don't repeat each other and share an answer.  An
empty table gives an empty table.  The columns ``n_words``, ``n_repeated``,
``n_removed`` and ``spans`` replace others of that name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from candlewick.llm.minimizers import MANY, PIECE, buckets, chain_rows, cover, keyed, pieces, settled, unpack
from candlewick.llm.words import lean, words_of
from candlewick.session import save

MIN_WORDS = 50
SPANS = "array<struct<start:int,length:int,removed:int>>"


def match_neighbours(table: pa.Table) -> tuple[np.ndarray, ...]:
    """(row, word, first) of the windows of a bucket that occur at two places
    or more; ``first``: at the smallest place of all."""
    row, at, key = unpack(table)
    k1, k2 = (table.column(c).to_numpy()[row] for c in ("_k1", "_k2"))
    order = np.lexsort((at, k2, k1, key))
    key_, k1_, k2_, at_ = key[order], k1[order], k2[order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = key_[1:] != key_[:-1]
    other = new.copy()
    other[1:] |= (k1_[1:] != k1_[:-1]) | (k2_[1:] != k2_[:-1]) | (at_[1:] != at_[:-1])
    if not len(order):
        return row[:0], at[:0], np.zeros(0, bool)
    # MANY counts even if the same place has come from another task without it
    many = np.bincount(np.cumsum(new) - 1, weights=table.column("_n").to_numpy()[row[order]] == MANY) > 0
    order, new = order[other], new[other]
    group = np.cumsum(new) - 1
    hit = (np.bincount(group) > 1)[group] | many[group]
    back = np.argsort(order[hit], kind="stable")        # text order again
    chosen = order[hit][back]
    return row[chosen], at[chosen], new[hit][back]


def repeated_pieces(docs: DataFrame, text: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``PIECE`` rows of the keyed documents."""
    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in buckets(batches):
            yield settled(table)
            yield pieces(table, *match_neighbours(table))

    rows = chain_rows(docs, text, min_words, same_place=False)
    return rows.repartition("_m").sortWithinPartitions("_m").mapInArrow(lean(compare), PIECE)


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later occurrences of repeated passages cut out of the
    text (all else is left as it is, byte for byte), and ``n_words``,
    ``n_repeated``, ``n_removed`` (words) and ``spans`` (maximal runs of
    repeated words: first word, length, words removed of them)."""
    added = {"n_words": "int", "n_repeated": "int", "n_removed": "int", "spans": SPANS}
    docs = keyed(docs.drop(*[c for c in added if c in docs.columns]), key, text)
    # written, so that the windows' shuffle is gone before texts are shuffled
    lists = save(repeated_pieces(docs, text, min_words), "passages").df.groupBy("_k1", "_k2").agg(
        F.collect_list(F.struct("_at", "_n", "_first")).alias("_pieces"))
    joined = docs.join(lists, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    schema = joined.drop("_pieces").withColumns({c: F.lit(None).cast(t) for c, t in added.items()}).schema
    arrow = to_arrow_schema(schema)
    names = joined.columns
    body = names.index(text)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                words = words_of(batch.column(body))
                lists = batch.column(batch.schema.get_field_index("_pieces")).to_pylist()
                texts, out = batch.column(body).cast(pa.binary()).to_pylist(), []
                origin = 0
                for i, (raw, found) in enumerate(zip(texts, lists, strict=True)):
                    f, t = words.first[i], words.first[i + 1]
                    out.append(_cut(raw, words.start[f:t] - origin, found or [], min_words))
                    origin += len(raw or b"")
                cols = [batch.column(batch.schema.get_field_index(c)) for c in names if c != "_pieces"]
                cols[body] = pa.array([o[0] for o in out], pa.binary()).cast(pa.string())
                cols += [pa.array([o[j] for o in out], arrow.field(len(cols) + j - 1).type) for j in range(1, 5)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return joined.mapInArrow(lean(cut), schema)


def _runs(on: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], on.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True))


def _cut(raw: bytes | None, start: np.ndarray, found: list[dict], k: int):
    n = len(start)
    if not found:
        return raw, n, 0, 0, []
    again = cover(n, k, [p["_at"] for p in found], [p["_n"] for p in found])
    later = [p for p in found if not p["_first"]]
    gone = cover(n, k, [p["_at"] for p in later], [p["_n"] for p in later])
    at, kept = 0, []
    for a, b in _runs(gone):
        kept.append(raw[at:start[a]])
        at = int(start[b]) if b < n else len(raw)
    kept.append(raw[at:])
    spans = [{"start": a, "length": b - a, "removed": int(gone[a:b].sum())} for a, b in _runs(again)]
    return b"".join(kept), n, int(again.sum()), int(gone.sum()), spans
