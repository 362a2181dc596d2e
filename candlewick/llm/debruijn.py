"""Substring dedup by De Bruijn compaction.

Every window of ``k`` words is an edge from its first ``k - 1`` words to its
last ``k - 1``.  An edge that starts at two or more source coordinates
(document, word) is repeated, and a word is removed if a repeated edge
covers it.

1. Edges are bucketed by minimiser (``minimizers.py``): a chain is a path of
   consecutive edges of one text, and travels as one row.
2. Inside a bucket the edges are sorted and counted by source coordinate.
   Repeated consecutive edges of a chain compact into one path piece, which
   ends where an edge is not repeated or the bucket ends, and keeps its
   source coordinates.
3. Pieces are joined to their documents and glued there: a piece that begins
   at the node where the one before ends continues the path.  Every path is
   checked to lie inside the text that its coordinates name.

Equal paths that one map task meets are combined before the shuffle, so a
passage that a third of all texts share costs its bucket one row per task.

Null text has no words.  Repeated rows are separate source coordinates, so
they remove each other.  An empty table gives an empty table.  Columns
``kept_text``, ``n_words`` and ``n_removed`` replace others of that name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from candlewick.llm.minimizers import MANY, PIECE, buckets, chain_rows, cover, keyed, pieces, settled, unpack
from candlewick.llm.words import lean
from candlewick.session import save

K = 35


def repeated(key: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def path_pieces(docs: DataFrame, text: str, k: int = K) -> DataFrame:
    """``PIECE`` rows: ``_n`` repeated edges from word ``_at`` on."""
    def compact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in buckets(batches):
            yield settled(table)
            row, at, key = unpack(table)
            # a chain that its map task has met twice is repeated, and so are others with its edges
            many = table.column("_n").to_numpy()[row] == MANY
            hit = repeated(key) | many
            yield pieces(table, row[hit], at[hit], np.zeros(int(hit.sum()), bool))

    rows = chain_rows(docs, text, k, same_place=True)
    return rows.repartition("_m").sortWithinPartitions("_m").mapInArrow(lean(compact), PIECE)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """``docs`` without the text, with ``kept_text`` (kept words joined by one
    space), ``n_words`` and ``n_removed``."""
    docs = keyed(docs, key, text)
    # written, so that the windows' shuffle is gone before texts are shuffled
    # and rows of one id and text have the same pieces: one list does for all
    found = save(path_pieces(docs, text, k), "path-pieces").df.dropDuplicates(["_k1", "_k2", "_at", "_n"])
    lists = found.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("_at", "_n")).alias("_pieces"))
    added = ["kept_text", "n_words", "n_removed"]
    joined = docs.join(lists, ["_k1", "_k2"], "left").drop("_k1", "_k2", *[c for c in added if c in docs.columns and c != text])
    kept = [c for c in joined.columns if c not in (text, "_pieces", *added)]
    schema = joined.select(*kept, F.lit("").alias("kept_text"), F.lit(0).cast("long").alias("n_words"),
                           F.lit(0).cast("long").alias("n_removed")).schema
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
                lists = batch.column(batch.schema.get_field_index("_pieces")).to_pylist()
                done = [glued(t, p, k) for t, p in zip(texts, lists, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index(c)) for c in kept]
                    + [pa.array([d[0].decode() for d in done], pa.string()), *(pa.array([d[i] for d in done], pa.int64()) for i in (1, 2))],
                    schema=arrow)

    return joined.mapInArrow(lean(cut), schema)


def glued(text: bytes | None, pieces: list[dict] | None, k: int) -> tuple[bytes, int, int]:
    """(kept words, words, removed words) of one text."""
    words = (text or b"").split()
    if not pieces:
        return b" ".join(words), len(words), 0
    gone = cover(len(words), k, [p["_at"] for p in pieces], [p["_n"] for p in pieces])
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g), len(words), int(gone.sum())
