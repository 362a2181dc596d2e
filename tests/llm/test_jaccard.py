"""Jaccard join against all pairs, and components against union-find."""

import random
import re

import pytest

from candlewick.llm import jaccard as J
from candlewick.llm.components import components


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0D]+", low) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids, root = sorted(sets), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), find(d)) for d in ids)


def near_copies(seed, vocabulary, n=150):
    rng = random.Random(seed)
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 120))] for _ in range(10)]
    rows = []
    for d in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            i = rng.randrange(len(w))
            w[i] = rng.choice(vocabulary) if rng.random() < .7 else w[i].upper()
        if rng.random() < .3:
            w = w[:rng.randint(0, len(w))]
        if rng.random() < .3:
            w += rng.choice(base)
        rows.append((d, " ".join(w) if d % 50 else None))
    return rows


@pytest.mark.parametrize("seed,vocabulary", [(1, "ab"), (2, "abcdefgh"), (3, [f"w{i}" for i in range(300)])])
def test_equals_all_pairs(spark, make_docs, seed, vocabulary):
    rows = near_copies(seed, vocabulary)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_join(make_docs(rows)).collect())
    assert got == brute(rows)


def test_the_last_round_alone_finds_every_link(spark, make_docs, monkeypatch):
    monkeypatch.setattr(J, "ROUNDS", 1)
    rows = near_copies(4, [f"w{i}" for i in range(40)], 100)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_join(make_docs(rows)).collect())
    assert got == brute(rows)


def test_links_of_columns_whose_head_links_with_nothing(spark, make_docs):
    w = [f"w{i}" for i in range(1, 12)]
    rows = [(1, " ".join([*w, "x"])), (2, " ".join([*w, "y"]))] + [(10 + i, " ".join(w[i:i + 5])) for i in range(7)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_join(make_docs(rows)).collect())
    assert got == brute(rows) and got[1] == (2, 8, 1)


def test_nulls_repeats_and_no_rows(spark, make_docs):
    docs = make_docs([(5, "a b c d e f"), (5, "a b c d e f"), (3, "A B C D E F"), (None, "a b c d e f"), (7, None), (8, " "), (9, "a b")])
    out = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_join(docs).collect()), key=str)
    assert out == sorted([(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, 3), (7, 0, 7), (8, 0, 8), (9, 1, 9)], key=str)
    assert J.jaccard_join(docs.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").df.collect()}
    root = {n: n for e in links for n in e}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    alone = {a for a, b in links if a == b} - {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: r for n, r in root.items() if n not in alone}
