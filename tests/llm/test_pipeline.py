"""The corpus pipeline against the same decisions taken by brute force."""

import random
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_jaccard import brute as components
from test_jaccard import shingles


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(400)]
                  for lang, letters in (("aa", "abcdefg"), ("xx", "pqrstuv"))}
    words = lambda lang, n: [rng.choice(vocabulary[lang]) for _ in range(n)]
    passage = words("aa", 70)
    rows = []
    for i in range(70):
        lang = rng.choice(["aa", "xx"])
        rows.append((i, " ".join(words(lang, rng.randint(60, 200))), lang, f"h{i % 4}"))
    for i in range(70, 80):         # one passage in ten texts
        rows.append((i, " ".join(words("aa", 80) + passage + words("aa", 90)), "aa", "h1"))
    for i in range(80, 95):         # near and exact copies
        w = rows[5][1].split()
        if i % 3:
            w[i % len(w)] = f"edit{i}"
        rows.append((i, " ".join(w), rows[5][2], "h2"))
    rows += [(95, "too short", "aa", "h0"), (96, "a b c " * 60, "aa", "h0"), (97, " ".join(str(i) for i in range(90)), None, "h0"),
             (98, None, None, None), (99, "", "aa", "h3")]
    rng.shuffle(rows)
    return rows


def repeat_words(w):
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    return len({i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)})


def decisions(rows):
    """{doc_id: text} after the first four stages."""
    kept = {}
    for d, t, *_ in rows:
        w = (t or "").split()
        if len(w) >= 50 and 100 * repeat_words(w) <= 50 * len(w) and re.search(r"[^\W\d_]", t):
            kept[d] = t
    best = {}
    for d, _, root in components(sorted(kept.items())):
        best[root] = min(best.get(root, (1, 0)), (-len(shingles(kept[d])), d))
    kept = {d: kept[d] for _, d in best.values()}
    first = {}
    for d in sorted(kept):
        w = kept[d].split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i:i + 50]), (d, i))
    out = {}
    for d, t in kept.items():
        w = t.split()
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i:i + 50])] != (d, i) for j in range(i, i + 50)}
        out[d] = [x for j, x in enumerate(w) if j not in gone]
    return out


def test_pipeline_equals_brute_force(spark, make_docs, tmp_path):
    rows = corpus()
    make_docs(rows, 4).write.parquet(str(tmp_path / "documents.parquet"))
    exp = decisions(rows)
    assert 60 < len(exp) < 90 and min(map(len, exp.values())) > 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        ids = [int.from_bytes(p["ids"][i:i + 4], "little") for i in range(0, len(p["ids"]), 4)]
        got.setdefault(p["doc_id"], []).extend(ids)
    assert got == {d: tokenizer.encode(" ".join(w), add_special_tokens=False).ids + [1] for d, w in exp.items()}


def test_stages_keep_the_columns_and_survive_odd_tables(spark, make_docs):
    docs = make_docs([(1, None, None, None), (None, "word " * 60, None, None), (2, "x", "aa", "h"), (2, "x", "aa", "h")])
    wide = docs.selectExpr("*", "1 as n_words", "'a' as _lang", "2 as kept", "3 as component_id", "4 as spans")
    for table in (docs, docs.where("false"), wide):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, "").columns == table.columns
            assert stage(spark, table, "").count() <= table.count()
    assert corpus_pipeline.STAGES[-1][1](spark, wide, "").where("start = 0").count() == 4


def test_one_copy_of_each_group_and_rows_without_an_id_stay(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(80))
    docs = make_docs([(3, text), (1, text), (1, text), (2, text + " more"), (None, text), (None, text), (9, None)])
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0) for r in out) == [0, 0, 2, 9]
