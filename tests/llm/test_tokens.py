"""BPE encoding, decoding and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewick.llm import bpe, packing
from candlewick.llm import queries as Q
from candlewick.llm.tokens import encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ALPHABETS = ["ab", "a", "thein ", "aé漢 \n", "'st re", "x  \t\x1c!\xa0", "0123ab<|endoftext|>", "ab .,", "é ́Iİs Σσ"]


def random_texts(seed, n):
    rng = random.Random(seed)
    texts = ["", " ", "\n\n", "<|endoftext|>"]
    for i in range(n):
        alphabet = rng.choice(ALPHABETS)
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 250)))
        texts.append(t + "<|endoftext|>" + t if i % 7 == 0 else t)
    return texts


@pytest.mark.parametrize("path,cut", [(BYTES, "spaced"), (WORDS, "words")])
def test_ids_equal_the_library(path, cut):
    library, enc = Tokenizer.from_file(path), encoder(path, cut)
    assert enc.fast
    for t in random_texts(1, 400):
        exp = library.encode(t, add_special_tokens=False).ids
        assert enc.ids(t).tolist() == exp, t
        if cut == "spaced":
            assert enc.text(exp) == library.decode(exp, skip_special_tokens=False)


def test_tree_concatenation_equals_the_library():
    library, enc, m = Tokenizer.from_file(BYTES), encoder(BYTES, "spaced"), bpe.merges(BYTES)
    how = {bpe.TEXT: lambda x: enc.ids(x).tolist(), bpe.TOKENS: lambda x: [i for t in x.split("\n") for i in m.ids(t)], bpe.TREE: m.ids}
    for n, t in enumerate(random_texts(2, 400)):
        got = []
        for _, same in groupby(bpe.parts_of(enc, t, (3, 8, 20)[n % 3]), key=lambda r: r[0]):
            got += bpe.join_tree([how[kind](part) for _, _, kind, part in same], m)
        assert got == library.encode(t, add_special_tokens=False).ids, t


def test_windows_grow_until_both_sides_agree():
    m, rng = bpe.merges(BYTES), random.Random(5)
    for alphabet in ("a", "ab", "aab", "thein"):
        t = "".join(rng.choice(alphabet) for _ in range(3000))
        cut = rng.randint(1, 2999)
        assert bpe.join_pair(m.ids(t[:cut]), m.ids(t[cut:]), m, window=1) == m.ids(t)


def test_encode_decode_in_spark(spark, make_docs):
    library = Tokenizer.from_file(BYTES)
    long = ["x" * 3000, "ab1." * 900 + " tail", " " * 2500 + "z", "word " * 600, "é" * 1500 + "<|endoftext|>" + "q" * 1200]
    rows = list(enumerate([None, "", "plain text", "plain text", *long, long[0]])) + [(0, None), (None, long[1])]
    docs = make_docs(rows).withColumn("ids", F.lit("old"))
    coded = bpe.bpe_encode(docs, BYTES, long=1000, leaf=64)
    assert set(coded.columns) == set(docs.columns)
    out = coded.withColumn("back", bpe.bpe_decode(BYTES, "ids")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["back"] == (r["text"] or "")
    assert bpe.bpe_encode(docs.where("false"), BYTES).count() == 0


def test_op4_query(spark):
    library = Tokenizer.from_file(BYTES)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in Q.QUERIES["op4_bpe_round_trip"](spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("dims,bits", [(2, 3), (4, 2)])
def test_hilbert_index_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = packing.hilbert_index(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(1) == 1).all()


def check_packing(docs, pieces, length):
    library = Tokenizer.from_file(WORDS)
    exp = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in docs)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4
        sequences[p["sequence_id"]].append(p)
        by_doc[p["doc_id"]].append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == length or at & (at - 1) == 0 and at < length       # no padding at all
    assert sum(p["length"] for p in pieces) == sum(map(len, exp))
    return by_doc, exp


def test_packing_places_every_id_once(spark, make_docs):
    rng = random.Random(3)
    docs = [(d, " ".join(rng.choice(["alpha", "beta", "gamma", "ß", "x1"]) for _ in range(rng.choice([0, 1, 5, 60, 900]))) if d % 9 else None)
            for d in range(40)]
    pieces = packing.pack(make_docs(docs), WORDS, length=128).collect()
    by_doc, _ = check_packing(docs, pieces, 128)
    library = Tokenizer.from_file(WORDS)
    for d, t in docs:
        ids, at = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and bytes(p["ids"]) == ids[at:at + p["length"]].tobytes()
            at += p["length"]
        assert at == len(ids)


def test_packing_copies_null_ids_and_no_rows(spark, make_docs):
    docs = [(1, "same text")] * 5 + [(None, "same text"), (None, None)]
    pieces = packing.pack(make_docs(docs).withColumnRenamed("n_chars", "length"), WORDS, length=8).collect()
    check_packing(docs, pieces, 8)
    assert packing.pack(make_docs(docs).where("false"), WORDS).count() == 0


def test_op9_query_sums(spark):
    out = Q.QUERIES["op9_hilbert_packing"](spark, SF).collect()
    library = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {d: np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4") for d, t in texts.items()}
    for r in out:
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes())
    assert sum(r["length"] for r in out) == sum(map(len, ids.values()))
