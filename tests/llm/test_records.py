"""Revisit resolution and license scan on hand-made cases."""

import datetime as dt
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candlewick.llm import license as L
from candlewick.llm import warc as W

T0 = dt.datetime(2024, 1, 1)
RECORD = "record_id long, kind string, url string, time timestamp, headers string"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def resolve(spark, rows, **kw):
    return {r["record_id"]: r for r in W.resolve_revisits(spark.createDataFrame(rows, RECORD).repartition(3), **kw).collect()}


def test_canonical_urls(spark):
    same = ["http://www.A.com:80/x/", "https://a.com/x", "//a.com/x#top", "a.com/x?utm_source=f", "https://a.com:443/x?ref=1", " http://a.com/x "]
    urls = same + ["https://a.com/x?b=2&a=1", "http://a.com/x?a=1&b=2&", "https://a.com/", "https://A.com", None, "http://a.com/X"]
    got = [r[0] for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i")
           .select(W.canonical_url(F.regexp_replace("u", "^//", ""))).collect()]
    assert got == ["a.com/x"] * 6 + ["a.com/x?a=1&b=2"] * 2 + ["a.com"] * 2 + [None, "a.com/X"]


def test_validators_and_headers(spark):
    full = 'ETag: "v1"\r\nLast-Modified: Mon\r\nContent-Type: text/html\r\nContent-Length: 9\r\nAge: 1\r\n'
    rows = [(1, "response", "http://a.com/x", at(0), full),
            (2, "revisit", "https://www.a.com/x/", at(10), 'etag: W/"v1"\r\nContent-Type: x/y\r\nAge: 7\r\nage: 8\r\nExpires: z\r\nbroken line\r\n'),
            (3, "revisit", "http://a.com/x", at(20), 'ETag: "v2"\r\n'), (4, "revisit", "http://a.com/x", at(20), "Last-Modified: Mon\r\n"),
            (5, "revisit", "http://a.com/x", at(20), "Last-Modified: Tue\r\n"), (6, "revisit", "http://a.com/x", at(20), "Age: 1\r\n"),
            (7, "revisit", "http://a.com/x", at(0), 'ETag: "v1"\r\n'), (8, "revisit", "http://b.com/", at(9), 'ETag: "v1"\r\n'),
            (9, "revisit", None, at(9), None), (10, "revisit", "http://a.com/x", None, 'ETag: "v1"\r\n'), (11, "request", "http://a.com/x", at(5), None)]
    got = resolve(spark, rows)
    assert {i: r["status"] for i, r in got.items()} == {
        2: "resolved", 3: "validator_mismatch", 4: "resolved", 5: "validator_mismatch", 6: "no_validator", 7: "no_earlier_response",
        8: "no_earlier_response", 9: "no_earlier_response", 10: "no_earlier_response"}
    assert got[2]["headers"] == {"etag": 'W/"v1"', "last-modified": "Mon", "content-type": "text/html", "content-length": "9", "age": "8", "expires": "z"}
    assert got[2]["response_id"] == 1 and got[3]["headers"] is None


def test_as_of_join_equals_a_scan(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["response", "revisit"]), rng.choice(["http://hot.com/", "http://hot.com/", f"http://u{i % 5}.com"]), at(rng.randint(0, 400)), 'ETag: "e"\r\n')
            for i in range(400)]
    for bucket in (7, 100, 10_000):
        got = resolve(spark, rows, bucket=bucket)
        for i, kind, url, t, _ in rows:
            if kind == "revisit":
                before = [(t2, j) for j, k, u, t2, _ in rows if k == "response" and u.rstrip("/") == url.rstrip("/") and t2 < t]
                assert got[i]["response_id"] == (max(before)[1] if before else None)


def test_no_records_and_repeated_ones(spark):
    assert W.resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0
    rows = [(1, "response", "a.com", at(0), 'ETag: "e"\r\n'), (2, "revisit", "a.com", at(1), 'ETag: "e"\r\n')] * 2
    df = spark.createDataFrame(rows, RECORD).withColumn("status", F.lit("old")).withColumn("_t", F.lit(1))
    assert [r["status"] for r in W.resolve_revisits(df).collect()] == ["resolved"] * 2


MIT, GPL = L.TEMPLATES["MIT"], L.TEMPLATES["GPL-3.0"]
FILES = [("root", "a/LICENSE", MIT), ("deep", "a/b/c/x.txt", "nothing here"), ("near", "a/b/COPYING", GPL.upper()),
         ("own", "a/b/y.txt", f"code code code\n{MIT}\nmore of the code"), ("out", "z/w.txt", "a text under the sun, version of this"),
         ("null", "a/q.txt", None), ("nowhere", None, "words"), ("top", "t.txt", ""), ("side", "ab/x.txt", "plain"),
         ("para", "z/p.txt", "first\n\n" + MIT.replace("the ", "the\n") + "\n\nlast " * 3)]


def scan(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id string, path string, body string").withColumn("license", F.lit("old"))
    return {r["id"]: (r["license"], r["origin"]) for r in L.scan(df, "id", "path", "body", **kw).collect()}


def test_headers_files_and_nearest_ancestors(spark):
    filler = [(f"f{i}", f"z/{i}.txt", f"the text of number {i} is under this") for i in range(40)]
    got = scan(spark, FILES + filler)
    assert got["root"] == ("MIT", "own") and got["near"] == ("GPL-3.0", "own") and got["own"] == ("MIT", "own")
    assert got["deep"] == ("GPL-3.0", "inherited") and got["null"] == ("MIT", "inherited") and got["para"] == ("MIT", "own")
    assert {got[k] for k in ("out", "nowhere", "top", "side", "f0")} == {(None, "none")}


def test_scan_of_no_files_and_repeated_files(spark):
    assert scan(spark, []) == {}
    df = spark.createDataFrame(FILES[:1] * 3 + FILES[1:2] * 2, "id string, path string, body string")
    assert sorted(r["origin"] for r in L.scan(df, "id", "path", "body").collect()) == ["inherited"] * 2 + ["own"] * 3


def test_other_words_count_with_their_own_idf(spark):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(30)]
    files = [(f"f{i}", f"z/{i}.txt", " ".join(rng.sample(common, 20))) for i in range(120)]
    headers = {f"h{i}": " ".join([L.TEMPLATES["GPL-3.0"], *common[:i]]) for i in range(1, 6)}
    files += [(k, f"h/{k}.txt", t) for k, t in headers.items()]
    words = {k: re.findall("[a-z0-9]+", t.lower()) for k, _, t in files}
    df = Counter(w for v in words.values() for w in set(v))
    vector = lambda v: {w: c * (math.log((1 + len(files)) / (1 + df[w])) + 1) for w, c in Counter(v).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    b = vector(re.findall("[a-z0-9]+", L.TEMPLATES["GPL-3.0"].lower()))
    table = spark.createDataFrame(files, "id string, path string, body string")
    got = {r["id"]: (r["license"], r["cosine"]) for r in L.scan(table, "id", "path", "body").collect()}
    for k in headers:
        a = vector(words[k])
        cosine = sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b)
        assert cosine > 0.9 and got[k] == ("GPL-3.0", pytest.approx(cosine, abs=1e-8))


def test_telling_words_bound_the_rest():
    weights = {"x": {"a": 3.0, "b": 1.0, "c": 0.5}, "y": {"d": 1.0, "e": 1.0}}
    chosen = set(L.telling_words(weights, 0.6))
    for v in weights.values():
        rest = sum(w * w for k, w in v.items() if k not in chosen) ** 0.5
        assert rest < 0.6 * sum(w * w for w in v.values()) ** 0.5


def test_ancestors(spark):
    got = [r[0] for r in spark.createDataFrame([("a/b",), ("a",), ("",)], "d string").select(L.ancestors(F.col("d"))).collect()]
    assert got == [["a/b", "a", ""], ["a", ""], [""]]
