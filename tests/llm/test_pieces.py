"""Agenda encoding against the library, and alignment against loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewick.llm import alignment as A
from candlewick.llm.pieces import PieceEncoder, piece_decode, piece_encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab e▁  \n\t.,ßé漢字🙂\x00\x01ﬁ<s></s><0x41>1２ं​﻿́ "
ODD = [None, "", " ", "  ", "a ", " a", "▁a", "a▁ b", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "\n\n\n", "été 漢字 🙂🙂",
       " " * 500, "ab" * 3000, "a  b   c    d" * 40, "字" * 300, "x\x00y", "the the the", "the the the", "'s 'll don't"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_and_text_equal_the_library(library):
    enc = PieceEncoder(PATH)
    for x in [*texts(3000, 1), *filter(None, ODD)]:
        ids = enc.batch(pa.array([x]))[0].tolist()
        assert ids == library.encode(x), x
        assert enc.text([*ids, enc.end]) == library.decode(library.encode(x, add_eos=True)), x


def test_any_ids_decode_as_in_the_library(library):
    enc, rng, lists = PieceEncoder(PATH), random.Random(2), [None]
    for _ in range(5000):
        ids = [rng.choice([rng.randint(0, 260), rng.randint(0, 31999), 28705, 259, 0, 1, 2]) for _ in range(rng.randint(0, 8))]
        assert enc.text(ids) == library.decode(ids), ids
        lists.append(ids)
    assert enc.texts(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [None, *map(library.decode, lists[1:])]


def test_heap_and_matrix_agendas_agree():
    enc = PieceEncoder(PATH)
    for x in texts(500, 3):
        whole = " " + x.replace("▁", " ") if x else ""
        assert enc.batch(pa.array([x]))[0].tolist() == enc.agenda(whole.replace(" ", "▁"))


def test_a_wrong_id_ends_the_job():
    enc = PieceEncoder(PATH)
    enc.chunk_ids = lambda chunks: (np.full(len(chunks), 5, np.int32), np.arange(len(chunks) + 1))
    with pytest.raises(RuntimeError, match="differ"):
        enc.batch(pa.array(["some words"]))


def test_encode_decode_frames(spark, make_docs, library):
    rows = list(enumerate(ODD)) + [(3, "  "), (3, "  ")]
    docs = make_docs(rows).withColumn("ids", F.lit("clash"))
    out = piece_encode(docs, PATH, decoded="lang").withColumn("back", piece_decode(PATH, "ids")).collect()
    assert len(out) == len(rows) and out[0].__fields__ == [*docs.columns, "back"]
    for r in out:
        ids = library.encode(r["text"] or "", add_eos=True)
        assert list(r["ids"]) == ids and r["back"] == r["lang"] == library.decode(ids)
    assert piece_encode(make_docs([]), PATH).count() == 0


# ---- alignment ---------------------------------------------------------------

def slow_alignment(rows, library):
    """Rows of (doc_id, text) by plain loops over tokens."""
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    symbol = A._byte_of()
    token = {i: bytes(symbol[c] for c in x) for x, i in t.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        piece = library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode()

    docs = []
    for _, text in rows:
        groups = []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
            if b"".join(token[i] for i in a) == (" " + text).encode() == b"".join(map(b_bytes, b)):
                at_a = at_b = 0
                left, right, i, j = [], [], 0, 0
                while i < len(a) or j < len(b):
                    if at_a <= at_b:
                        left.append(a[i])
                        at_a += len(token[a[i]])
                        i += 1
                    else:
                        right.append(b[j])
                        at_b += len(b_bytes(b[j]))
                        j += 1
                    if at_a == at_b:
                        groups.append((left, right))
                        left, right = [], []
        docs.append(groups)
    links = [Counter((x, y) for left, right in g for x in left for y in right) for g in docs]
    count = Counter(p for x in links for p in x)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (d, _), g, link in zip(rows, docs, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(link.values()),
                    sum(n for p, n in link.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in link.items()), text))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_loops(spark, make_docs, library, monkeypatch, small):
    if small:       # many blocks, salts, shards and rounds of pairs
        for name, value in (("BLOCK_BYTES", 200), ("SALTED", 7), ("TABLE_BYTES", 1 << 25), ("PAIRS", 3)):
            monkeypatch.setattr(A, name, value)
    rows = [*enumerate(ODD), *enumerate(texts(60, 4), 100), (100, "a b"), (100, "a b")]
    docs = make_docs(rows).withColumn("n_a", F.lit("clash"))
    got = A.align(docs, BYTES, PATH)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert got.columns == names
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow_alignment(rows, library)


def test_alignment_of_nothing(spark, make_docs):
    assert A.align(make_docs([]), BYTES, PATH).count() == 0


def test_terminals_are_the_common_ends():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 40)
        a, b = (sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}) for _ in range(2))
        common = sorted({*a} & {*b})
        ga, gb = A.groups_of(np.array(a), np.array(b))
        assert ga.tolist() == [sum(c < x for c in common) for x in a]
        assert gb.tolist() == [sum(c < x for c in common) for x in b]


def test_queries_over_a_table(spark, library, tmp_path):
    from candlewick.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = sorted((tuple(r) for r in queries.op12_token_alignment(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((*r[:7], sha(r[7]) if r[7] else "") for r in slow_alignment(rows, library)), key=str)
    ids = {d: library.encode(t or "", add_eos=True) for d, t in rows}
    got = sorted(tuple(r) for r in queries.op13_sentencepiece(spark, str(tmp_path)).collect())
    assert got == sorted((d, len(x), sha(" ".join(map(str, x))), sha(library.decode(x))) for d, x in ids.items())
