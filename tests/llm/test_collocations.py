"""Collocations against plain counting, and the merge of one stream."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm import collocations as C


def slow(rows, max_words=3, least=10, inside=50, top=2000):
    count, words = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            words[lang] += len(w)
            for n in range(1, max_words + 1):
                count.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    found = {}
    for (lang, p), a in count.items():
        if len(p) < 2 or a < least:
            continue
        cuts = [(1_000_000 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang, p] = (score, a, count[lang, p[:k]], count[lang, p[k:]])
    covered = set()
    for (lang, p), (_, f, _, _) in found.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                part = p[i:i + n]
                if 100 * f >= inside * count[lang, part]:
                    covered.add((lang, part))
    out = []
    for lang in words:
        best = sorted((-s, -a, " ".join(p).encode(), l, r) for (g, p), (s, a, l, r) in found.items() if g == lang and (g, p) not in covered)
        out += [(lang, i + 1, p.decode(), -a, l, r, words[lang], -s) for i, (s, a, p, l, r) in enumerate(best[:top])]
    return sorted(out)


def made(seed, vocabulary, n=120):
    rng = random.Random(seed)
    fixed = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 5))] for _ in range(6)]
    rows = []
    for d in range(n):
        w = []
        for _ in range(rng.randint(0, 30)):
            w += rng.choice(fixed) if rng.random() < .5 else [rng.choice(vocabulary)]
            w[-1] += rng.choice(["", "", "", ".", " \t", ", ", "\n", " ", " "]) if w else ""
        rows.append((d, rng.choice([" ".join(w), " ".join(w).upper()]), rng.choice(["en", "en", "de", None, "und", ""])))
    return [*rows, (n, None, "en"), (n, "", None), (n, "...", "fr"), (n + 1, "só só " * 50, "pt"), (n + 1, "só só " * 50, "pt")]


def got(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed,vocabulary", [(1, "abc"), (2, [*"abcdefgh", "été", "x\x01y", "漢字"])])
def test_equals_counting(spark, make_docs, seed, vocabulary):
    rows = made(seed, vocabulary)
    docs = make_docs(rows).withColumn("_phrase", F.lit("clash")).withColumn("score", F.lit("clash"))
    assert got(C.collocations(docs)) == slow(rows)


def test_small_steps_pieces_and_longer_phrases(spark, make_docs, monkeypatch):
    monkeypatch.setattr(C, "SORTED_WORDS", 7)
    monkeypatch.setattr(C, "SORTED_BYTES", 50)
    rows = made(3, "abcd", 60)
    assert got(C.collocations(make_docs(rows), max_words=4, least=3, inside=60, top=9)) == slow(rows, 4, 3, 60, 9)
    assert got(C.collocations(make_docs(rows), max_words=2, least=2)) == slow(rows, 2, 2)


def test_very_long_text(spark, make_docs, monkeypatch):
    monkeypatch.setattr(C, "SORTED_WORDS", 1000)
    rng = random.Random(4)
    rows = [(1, " ".join(rng.choice("abcdefghij") for _ in range(30_000)), "en")]
    assert got(C.collocations(make_docs(rows))) == slow(rows)


def test_empty_table(spark, make_docs):
    assert C.collocations(make_docs([])).count() == 0


def test_numbers_beyond_64_bits(spark):
    a, left, right = 4 * 10 ** 14, 5 * 10 ** 14, 7 * 10 ** 14
    row = spark.createDataFrame([(a, [left], [right])], "a long, x array<long>, y array<long>")
    s = row.select(C._scored(F.col("a"), F.col("x"), F.col("y")).alias("s")).first()["s"]
    assert s["score"] == 1_000_000 * a * a // (left * right)


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_merge_of_one_piece(size):
    """However the rows are cut into batches; the first two are another piece's."""
    rows = [("en", "a", 1, 50, False), ("en", "a b", 2, 40, False), ("en", "a b c", 3, 12, True), ("en", "a b d", 3, 20, True),
            ("en", "a c", 2, 11, True), ("en", "b", 1, 60, True), ("en", "b c", 2, 15, True), ("en", "c", 1, 70, True)]
    names = ["_lang", "_phrase", "_words", "_c", "_own"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_()]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[i:i + size], strict=True), kinds, strict=True)], names)
               for i in range(0, len(rows), size)]
    out = sorted((tuple(r.values()) for b in C.merge_stream(batches, 3) for r in b.to_pylist()), key=lambda r: r[1])
    assert out == [("en", "a", 1, None, None, 11), ("en", "a b", 2, None, None, 20), ("en", "a b c", 3, 12, [50, 40], 0),
                   ("en", "a b d", 3, 20, [50, 40], 0), ("en", "a c", 2, 11, [50], 0), ("en", "b", 1, 60, [], 15),
                   ("en", "b c", 2, 15, [60], 0), ("en", "c", 1, 70, [], 0)]
