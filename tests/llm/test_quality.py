"""Host-level quality rules against a plain count, and edge cases."""

import re
from collections import Counter

import duckdb
import pytest

from candlewick.llm import queries as Q
from candlewick.llm.quality import MAX_PRIOR, _priors, document_rules, host_verdicts, quality_rules

SF = "/root/testdata/sf0.001"


def repeat_words(words):
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    return len({i + o for i, g in enumerate(grams) if n[g] > 1 for o in range(3)})


TEXTS = ["", None, "a", "a b c a b c", "a a a a", "x y z\nx y z\n\n \nq", "p\x0bq\x0cr\ts", "é#é|<> 漢字 $ x", "w " * 5000,
         "one two three " * 40 + "four"]


def test_counts_equal_a_plain_count(spark, make_docs):
    got = {r["doc_id"]: r for r in document_rules(make_docs(list(enumerate(TEXTS)))).collect()}
    for i, text in enumerate(TEXTS):
        words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
        lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r["_q_words"], r["_q_chars"], r["_q_symbols"], r["_q_dup_lines"], r["_q_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat_words(words)), text


def test_prior_shrinks_small_hosts(spark, make_docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "en", "big") for i in range(40)] + [(100 + i, "short", "en", "bad") for i in range(40)] + [(200, "short", "en", "tiny"), (201, good, "en", None)]
    scored = document_rules(make_docs(rows))
    rate = {r["_q_host"]: r["_q_rate_too_short"] for r in host_verdicts(scored, "source").collect()}
    assert rate["big"] < 0.05 and rate["bad"] > 0.95 and rate["big"] < rate["tiny"] < rate["bad"]
    kept = {r["doc_id"]: (r["_q_base_failed"], r["_q_kept"]) for r in quality_rules(make_docs(rows + [(300, good, "en", "bad")])).collect()}
    assert kept[0] == (False, True) and kept[100] == (True, False)
    assert kept[300] == (False, False)          # a clean text of a host that is rejected
    assert kept[201] == (False, True)           # no host, no verdict


def test_doubtful_texts_of_hosts_worse_than_their_peers(spark, make_docs):
    """The host decides on texts that fail ``symbols`` or ``dup_lines``; clean
    texts stay, and so do doubtful ones of ordinary hosts or of none."""
    good = " ".join(f"w{i}" for i in range(60))
    doubtful = " ".join(f"w{i}#" for i in range(60))
    lines = "\n".join([" ".join(f"v{i}" for i in range(60))] + ["next page"] * 6)
    rows = [(h * 100 + i, doubtful if i < 3 else good, "en", f"peer{h}") for h in range(8) for i in range(60)]
    rows += [(1000 + i, (doubtful, lines, good)[i % 3], "en", "farm") for i in range(60)] + [(2000, doubtful, "en", None)]
    out = {r["doc_id"]: r for r in quality_rules(make_docs(rows)).collect()}
    assert len(out) == len(rows)
    assert {r["source"] for r in out.values() if r["_q_host_worse"]} == {"farm"}
    assert out[2000]["_q_host_worse"] is None
    lost = {i for i, r in out.items() if not r["_q_kept"]}
    assert lost == {1000 + i for i in range(60) if i % 3 < 2}
    assert not any(r["_q_base_failed"] for r in out.values())


def test_one_host_is_its_own_peer(spark, make_docs):
    doubtful = " ".join(f"w{i}#" for i in range(60))
    good = " ".join(f"w{i}" for i in range(60))
    out = quality_rules(make_docs([(i, good if i % 2 else doubtful, "en", "only") for i in range(9)])).collect()
    assert len(out) == 9 and all(r["_q_kept"] and not r["_q_host_worse"] for r in out)


def test_equal_rates_and_no_rows(spark, make_docs):
    scored = document_rules(make_docs([(1, "short", "en", "a"), (2, "short", "en", "b")]))
    hosts = scored.groupBy("source").count().selectExpr("source", "count as _q_n", *[f"0L as _q_f_{r}" for r in ("too_short", "repetitive", "symbols", "dup_lines")])
    assert _priors(hosts)["too_short"] == (0.0, MAX_PRIOR)
    out = quality_rules(make_docs([(1, "x", "en", "a")]).where("false"))
    assert out.count() == 0 and "_q_kept" in out.columns


def test_other_columns_and_repeated_rows_stay(spark, make_docs):
    docs = make_docs([(1, "a b", "en", "h"), (1, "a b", "en", "h"), (None, None, None, None)]).withColumnRenamed("n_chars", "rate")
    out = quality_rules(docs)
    assert out.count() == 3 and set(docs.columns) <= set(out.columns)


@pytest.mark.parametrize("name", ["op2_quality_rules", "op7_warc_revisits", "op8_license_scan"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    exp = con.sql(f"SELECT {', '.join(cols)} FROM ({Q.ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, exp))
