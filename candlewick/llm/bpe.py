"""BPE encoding and decoding; long unsplit text by tree concatenation.

Texts whose runs without white space (and of white space) are all short are
encoded in place.  A text with a run of ``LONG`` characters or more is taken
apart:

1. the run is cut by the tokenizer's own pre-tokenizer, and every pre-token
   longer than ``LEAF`` bytes into equal leaves (the leaves of a binary tree);
   all pieces become rows, dealt evenly over the cluster and encoded there;
2. per text, neighbouring leaves are joined up the tree.  A join re-encodes a
   window of tokens around the seam and widens it until the window's first
   token is the left side's and its last token the right side's.  Merges are
   a local matter between neighbouring tokens (a token sequence is what BPE
   makes of its bytes if and only if that holds for each pair of
   neighbours), so agreement at both ends makes the whole exact; in the
   worst case the window is everything.

Null text counts as empty.  Repeated rows each get their ids; equal long
texts are encoded once.  An empty table gives an empty table.  The output
column replaces one of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.tokens import Encoder, encoder

LONG = 65_536    # characters of a run without white space, or of white space
LEAF = 16_384    # bytes of a tree leaf
WINDOW = 8       # tokens on each side of a seam, doubled until both agree


def bpe_encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids",
               long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """``docs`` with ``out``: array<int>, the ids of the whole text."""
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        enc = encoder(path, "spaced")
        return pa.array([enc.ids(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))

    body = F.coalesce(F.col(text), F.lit(""))
    run = (F.length(body) >= long) & body.rlike(rf"(?<!\S)\S{{{long}}}|(?<!\s)\s{{{long}}}")
    short = docs.where(~run).withColumn(out, encode(F.col(text)))
    joined = _encode_long(docs.where(run).select(F.sha2(body, 256).alias("_bpe_key"), body.alias("_bpe_text")),
                          path, leaf)
    rest = docs.where(run).withColumn("_bpe_key", F.sha2(body, 256)).drop(*([out] if out in docs.columns else []))
    rest = rest.join(joined.withColumnRenamed("_bpe_ids", out), "_bpe_key").drop("_bpe_key")
    return short.unionByName(rest.select(short.columns))


def bpe_decode(path: str, ids: Column | str) -> Column:
    """The text of an array of ids, special tokens included."""
    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        enc = encoder(path, "spaced")
        return pa.array([enc.text(x.values.to_numpy().tolist()) if x.is_valid else None for x in column], pa.string())

    return decode(ids)


# ---- long unsplit text -------------------------------------------------

#: What a part holds: text cut at white space, pre-tokens one a line, or one leaf of a long pre-token.
TEXT, TOKENS, TREE = 0, 1, 2
_PART = "_bpe_key string, _bpe_piece int, _bpe_leaf int, _bpe_kind int, _bpe_part string"


class Merges:
    """The tokenizer's merges alone, on the byte-level alphabet."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.pre_tokenizer = None
        self.tokenizer.encode_special_tokens = True

    def ids(self, symbols: str) -> list[int]:
        return self.tokenizer.encode(symbols, add_special_tokens=False).ids if symbols else []

    def symbols(self, ids: list[int]) -> str:
        return "".join(map(self.tokenizer.id_to_token, ids))


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def join_pair(left: list[int], right: list[int], m: Merges, window: int = WINDOW) -> list[int]:
    """Ids of the joined bytes of two encoded parts of one pre-token."""
    while left and right:
        a, b = min(window, len(left)), min(window, len(right))
        mid = m.ids(m.symbols(left[-a:] + right[:b]))
        if (a == len(left) or mid[0] == left[-a]) and (b == len(right) or mid[-1] == right[b - 1]):
            return left[:-a] + mid + right[b:]
        window *= 2
    return left + right


def join_tree(leaves: list[list[int]], m: Merges) -> list[int]:
    while len(leaves) > 1:
        leaves = [join_pair(leaves[i], leaves[i + 1], m) if i + 1 < len(leaves) else leaves[i]
                  for i in range(0, len(leaves), 2)]
    return leaves[0] if leaves else []


def parts_of(enc: Encoder, text: str, leaf: int) -> Iterator[tuple[int, int, int, str]]:
    """(piece, leaf, kind, part) of one text, in order."""
    special = re.compile("|".join(re.escape(t.content) for t in enc.tokenizer.get_added_tokens_decoder().values()))
    piece = 0

    def grouped(strings: Iterable[str], sep: str) -> Iterator[str]:
        held: list[str] = []
        size = 0
        for x in strings:
            if held and size + len(x) > leaf:
                yield sep.join(held)
                held, size = [], 0
            held.append(x)
            size += len(x)
        if held:
            yield sep.join(held)

    for is_run, chunks in groupby(enc.chunks(text), key=lambda c: len(c) > leaf):
        if not is_run:
            for part in grouped(chunks, ""):
                yield piece, 0, TEXT, part
                piece += 1
            continue
        for chunk in chunks:
            at = 0
            for m in [*special.finditer(chunk), None]:
                plain = chunk[at:m.start()] if m else chunk[at:]
                tokens = [t for t, _ in enc.tokenizer.pre_tokenizer.pre_tokenize_str(plain)] if plain else []
                for long, same in groupby(tokens, key=lambda t: len(t) > leaf):
                    if not long:
                        for part in grouped(same, "\n"):
                            yield piece, 0, TOKENS, part
                            piece += 1
                        continue
                    for token in same:
                        for j, i in enumerate(range(0, len(token), leaf)):
                            yield piece, j, TREE, token[i:i + leaf]
                        piece += 1
                if m:
                    yield piece, 0, TEXT, m[0]
                    piece, at = piece + 1, m.end()


def _encode_long(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    """(_bpe_key, _bpe_ids) of the distinct texts of (_bpe_key, _bpe_text)."""
    def cut(batches):
        enc = encoder(path, "spaced")
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [{"_bpe_key": key, "_bpe_piece": p, "_bpe_leaf": j, "_bpe_kind": k, "_bpe_part": x}
                        for p, j, k, x in parts_of(enc, text, leaf)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema(
                    [("_bpe_key", pa.string()), ("_bpe_piece", pa.int32()), ("_bpe_leaf", pa.int32()),
                     ("_bpe_kind", pa.int32()), ("_bpe_part", pa.string())]))

    @F.arrow_udf("array<int>")
    def encode(kinds: pa.Array, parts: pa.Array) -> pa.Array:
        enc, m = encoder(path, "spaced"), merges(path)
        how = {TEXT: enc.ids, TOKENS: lambda x: [i for t in x.split("\n") for i in m.ids(t)], TREE: m.ids}
        return pa.array([how[k](x) for k, x in zip(kinds.to_pylist(), parts.to_pylist(), strict=True)],
                        pa.list_(pa.int32()))

    def join(group: pa.Table) -> pa.Table:
        m = merges(path)
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("_bpe_piece", "_bpe_leaf", "_bpe_ids")), strict=True))
        ids = [i for _, same in groupby(rows, key=lambda r: r[0]) for i in join_tree([r[2] for r in same], m)]
        return pa.table({"_bpe_key": group.column("_bpe_key")[:1], "_bpe_ids": pa.array([ids], pa.list_(pa.int32()))})

    parts = texts.dropDuplicates(["_bpe_key"]).mapInArrow(cut, _PART)
    coded = (parts.repartition("_bpe_key", "_bpe_piece", "_bpe_leaf")
             .select("_bpe_key", "_bpe_piece", "_bpe_leaf", encode("_bpe_kind", "_bpe_part").alias("_bpe_ids")))
    # a group is the pieces of one text, which came from one row
    return coded.groupBy("_bpe_key").applyInArrow(join, "_bpe_key string, _bpe_ids array<int>")
