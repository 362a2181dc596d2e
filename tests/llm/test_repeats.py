"""Suffix-array and De Bruijn dedup against brute force over all windows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import minimizers as M
from candlewick.llm.debruijn import remove_repeats
from candlewick.llm.suffixes import remove_passages
from candlewick.llm.words import slices, words_of


def sample(seed, alphabet="abcdefgh"):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice(alphabet) for _ in range(rng.randint(5, 90))) for _ in range(6)]
    rows = [(d, " ".join(rng.choice(passages) if rng.random() < .5 else " ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
                         for _ in range(rng.randint(0, 8))) if d % 13 else None) for d in range(50)]
    return rows + [rows[3], rows[3], rows[4], (777, "a " * 200), (778, "x y\n" * 100), (779, ""), (780, " \t ")]


def cover(words, k, hit):
    return [any(hit(tuple(words[i:i + k]), i) for i in range(max(0, j - k + 1), min(j, len(words) - k) + 1)) for j in range(len(words))]


@pytest.mark.parametrize("seed,k", [(1, 35), (2, 10)])
def test_de_bruijn_equals_brute_force(spark, make_docs, seed, k):
    rows = sample(seed) + [(None, "p q r " * 20)]
    split = [(t or "").split() for _, t in rows]
    n = Counter(tuple(w[i:i + k]) for w in split for i in range(len(w) - k + 1))
    exp = []
    for (d, _), w in zip(rows, split):
        gone = cover(w, k, lambda g, _: n[g] > 1)
        exp.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeats(make_docs(rows), k=k).collect()]
    assert sorted(got, key=str) == sorted(exp, key=str)


@pytest.mark.parametrize("seed,k", [(1, 50), (2, 10), (5, 12)])
def test_suffixes_equal_brute_force(spark, make_docs, seed, k):
    rows = sample(seed)
    docs = sorted({(d, t or "") for d, t in rows})
    first, n = {}, Counter()
    for d, t in docs:
        w = t.split()
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            n[g] += 1
            first.setdefault(g, (d, i))
    out = remove_passages(make_docs(rows), min_words=k).collect()
    assert len(out) == len(rows)
    by_id = {d: t for d, t in docs}
    for r in out:
        w = by_id[r["doc_id"]].split()
        again = cover(w, k, lambda g, _: n[g] > 1)
        gone = cover(w, k, lambda g, i, d=r["doc_id"]: n[g] > 1 and first[g] != (d, i))
        assert (r["n_words"], r["n_repeated"], r["n_removed"]) == (len(w), sum(again), sum(gone))
        assert (r["text"] or "").split() == [x for x, g in zip(w, gone) if not g]
        assert sum(s["length"] for s in r["spans"]) == sum(again) and sum(s["removed"] for s in r["spans"]) == sum(gone)
        if not any(gone):
            assert (r["text"] or "") == by_id[r["doc_id"]]      # clean texts stay byte for byte


def test_common_grams_are_dealt_by_window(spark, make_docs, monkeypatch):
    """Every bucket with two sampled chains is split: the answers stay."""
    rows = sample(8, "abcd")
    whole = {(r["doc_id"], r["kept_text"]) for r in remove_repeats(make_docs(rows), k=12).collect()}
    cut = {(r["doc_id"], r["text"], str(r["spans"])) for r in remove_passages(make_docs(rows), min_words=12).collect()}
    monkeypatch.setattr(M, "HOT", 1)
    monkeypatch.setattr(M, "TOLD_BY", 1)
    assert len(M.hot_grams(M.keyed(make_docs(rows), "doc_id", "text"), "text", 12)) > 50
    assert {(r["doc_id"], r["kept_text"]) for r in remove_repeats(make_docs(rows), k=12).collect()} == whole
    assert {(r["doc_id"], r["text"], str(r["spans"])) for r in remove_passages(make_docs(rows), min_words=12).collect()} == cut


def test_clashing_columns_empty_tables_and_string_ids(spark, make_docs):
    docs = make_docs([(1, "a b c"), (2, None)]).selectExpr("cast(doc_id as string) as doc_id", "text", "1 as n_words", "'x' as spans", "2 as n_removed", "3 as kept_text")
    assert {r["doc_id"]: r["n_words"] for r in remove_passages(docs).collect()} == {"1": 3, "2": 0}
    assert {r["doc_id"]: r["kept_text"] for r in remove_repeats(docs).collect()} == {"1": "a b c", "2": ""}
    assert remove_passages(docs.where("false")).count() == 0 == remove_repeats(docs.where("false")).count()


def test_one_very_long_text_with_a_repeat(spark, make_docs):
    words = [f"w{i}" for i in range(60_000)]
    words[50_000:50_060] = words[10:70]
    r = remove_passages(make_docs([(1, " ".join(words)), (2, "z")])).where("doc_id = 1").first()
    assert (r["n_repeated"], r["n_removed"]) == (120, 60) and len(r["text"].split()) == 59_940


def test_chains_hold_each_window_once_under_its_minimiser():
    rng = random.Random(3)
    texts = pa.array([" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 120))) for _ in range(20)])
    w = words_of(texts)
    m, at, count, hashes = M.chains(w, 20, 5)
    starts = np.concatenate([np.arange(a, a + c) for a, c in zip(at, count)])
    exp = [i for t in range(20) for i in range(w.first[t], w.first[t + 1] - 19)]
    assert starts.tolist() == exp and len(hashes) == len(exp) and count.max() <= 16


def test_map_side_combine_settles_all_but_the_first():
    c = M._Combiner(same_place=False)
    digest = np.array([7, 7, 8, 7], np.uint64)
    places = np.array([[1, 1, 1, 2], [0, 0, 0, 0], [0, 5, 9, 0]])
    assert c.settle(digest, places).tolist() == [M.MANY, 1, 0, 1]
    assert c.settle(np.array([7, 7], np.uint64), np.array([[0, 1], [0, 0], [0, 0]])).tolist() == [M.MANY, 1]
    assert c.settle(np.array([7], np.uint64), np.array([[0], [0], [0]])).tolist() == [2]    # the same place again


def test_slices_cover_a_batch():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * 30, None, "", "y" * 100, "z"]})
    parts = list(slices(batch, "t", 40))
    assert [p.num_rows for p in parts] == [3, 1, 1] and sum(p.num_rows for p in parts) == 5
