"""Language network (gradients, held-out accuracy) and neighbour graph (recall)."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from candlewick.llm import ann, graph, langid
from candlewick.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = Q.QUERIES["op6_language_id"](spark, SF).collect()
    assert len(out) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in out)
    test = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in test) >= 0.95 * len(test)


def two_languages(n=80):
    rng = random.Random(1)
    return [(i, " ".join("".join(rng.choice("abc" if i % 2 else "xyz") for _ in range(4)) for _ in range(40)), "aa" if i % 2 else "xx") for i in range(n)]


def test_training_ignores_other_columns_and_order(spark, make_docs):
    rows = two_languages()
    a = langid.fit_language_model(make_docs(rows, 1), F.lit(True))
    b = langid.fit_language_model(make_docs([(*r, f"src{r[0]}") for r in reversed(rows)], 4), F.lit(True))
    assert a.labels == ["aa", "xx"] and np.array_equal(a.conv, b.conv) and np.array_equal(a.out, b.out)
    lang, score = langid.predict(a, pa.array(["abca bcab", "zyxx yzyx", None, "", "12 !?", "ßß", "abc " * 40_000]))
    assert lang[:2] == ["aa", "xx"] and lang[2:5] == ["und"] * 3 and score[2:5].tolist() == [0] * 3
    assert lang[5] in ("aa", "xx") and lang[6] == "aa" and score[6] > 0.9


def test_a_long_text_is_judged_by_all_its_windows():
    model = langid.ByteConv(["a", "b"], *[np.zeros(s, np.float32) for s in ((256, langid.EMBED), (4 * langid.EMBED, 48), 48, (48, 2), 2)])
    seen = []
    model.log_probs = lambda w: (seen.append(len(w)), np.zeros((len(w), 2)))[1]
    langid.predict(model, pa.array(["x" * 256 * 5000, "y", None, "z" * 257]), block=512)
    assert sum(seen) == 5000 + 1 + 2 and max(seen) <= 512


def test_no_labels_clashing_columns_and_no_rows(spark, make_docs):
    docs = make_docs([(1, "abc", None), (1, "abc", None)]).withColumn("lang_pred", F.lit("old"))
    assert langid.fit_language_model(docs, F.lit(True)) is None
    assert [r["lang_pred"] for r in langid.identify_language(docs, None).collect()] == ["und"] * 2
    assert langid.identify_language(docs.where("false"), None).count() == 0


def test_gradient_of_one_step_lowers_the_loss():
    rng = np.random.default_rng(0)
    w = rng.integers(97, 100, (64, langid.WINDOW)).astype(np.uint8)
    w[32:] += 20
    y = np.repeat([0, 1], 32)
    net = langid.train(w, y, ["a", "b"])
    assert (net.log_probs(w).argmax(1) == y).all()


# ---- neighbours ----------------------------------------------------------

def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        i = ids.index(q)
        s = x @ x[i]
        out[q] = [ids[j] for j in np.lexsort((ids, -s)) if j != i][:k]
    return out


def test_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 600)
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(12, 16))[rng.integers(0, 12, 2500)] + 0.6 * rng.normal(size=(2500, 16))) * rng.uniform(0.5, 2, (2500, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    exp = brute(list(range(2500)), x, range(0, 2500, 20), 20)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == 20 * len(exp)
    assert np.mean([(q, v) in found for q, vs in exp.items() for v in vs]) >= 0.9
    for r in got:
        assert abs(r["score"] - x[r["query_id"]] @ x[r["vec_id"]]) < 1e-12


def test_copies_ties_and_vectors_that_take_no_part(spark):
    same = [1.0, 0.0]
    rows = [(i, same) for i in range(100)] + [(200, [0.0, 1.0]), (201, None), (202, [0.0, 0.0]), (203, [float("nan"), 1.0]), (204, [None, 1.0]),
                                              (205, [float("inf"), 0.0]), (206, []), (207, [1.0, 2.0, 3.0]), (None, same), (20, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.nearest(df, F.col("vec_id") % 20 == 0, k=3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())
    assert got == sorted((q, i + 1, v, s) for q in (0, 20, 40, 60, 80, 200)
                         for i, (v, s) in enumerate([(v, 0.0 if q == 200 else 1.0) for v in (0, 1, 2, 3) if v != q][:3]))
    assert ann.nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.nearest(df.where("vec_id in (20, 200)"), F.col("vec_id") % 20 == 0, k=3).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in few) == [(20, 200), (200, 20)]


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0]], np.float32)
    kept = graph.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, 0, 1, -1]]), 4, 1.2)
    assert [i for i in kept[0].tolist() if i >= 0] == [1, 3, 4]      # 2 lies close behind 1


def test_every_node_is_reachable():
    x = np.random.default_rng(2).normal(size=(700, 8)).astype(np.float32)
    edges, start = graph.build(x)
    seen, todo = {start}, [start]
    while todo:
        for j in edges[todo.pop()]:
            if j >= 0 and j not in seen:
                seen.add(int(j))
                todo.append(int(j))
    assert len(seen) >= 0.99 * len(x)
