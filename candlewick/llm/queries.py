"""Registered queries of the training-data operators: ``opN_<name>``.

Each applies its operator with production parameters to its whole table and
derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per repeated passage; documents without any have no row."""
    from candlewick.llm.suffixes import remove_passages

    out = remove_passages(_documents(spark, sf_dir).select("doc_id", "text"), min_words=50)
    spans = out.select("doc_id", "n_words", F.inline("spans"))
    return spans.select("doc_id", "n_words", F.col("start").alias("start_word"), F.col("length").alias("passage_words"),
                        F.col("removed").alias("removed_words"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.quality import quality_rules

    docs = _documents(spark, sf_dir).select("doc_id", "text", "source")
    out = quality_rules(docs, host="source", drop_text=True)
    return out.select(
        "doc_id", F.col("_q_words").alias("n_words"), F.col("_q_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), F.col("_q_dup_lines").alias("n_dup_lines"),
        F.col("_q_repeat_words").alias("n_repeat_words"), F.col("_q_base_failed").alias("base_failed"),
        F.round("_q_host_rate", 6).alias("host_rate"), F.round("_q_host_bound", 6).alias("host_bound"),
        F.col("_q_host_worse").alias("host_worse"), F.col("_q_kept").alias("kept"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.debruijn import remove_repeats

    out = remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"), k=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from candlewick.llm.bpe import bpe_decode, bpe_encode

    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe_encode(_documents(spark, sf_dir).select("doc_id", "text"), path).drop("text")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe_decode(path, "ids"), 256).alias("decoded_sha256"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.jaccard import jaccard_join

    out = jaccard_join(_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.langid import fit_language_model, held_out, identify_language

    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    test = held_out(F.col("doc_id"))
    out = identify_language(docs, fit_language_model(docs, ~test))
    return out.select("doc_id", test.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from candlewick.llm.packing import pack

    pieces = pack(_documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.ann import nearest

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archive records per page: the full response and a later 304.

    Times are spread over days by the URL's digest; every 304 carries the
    page's entity tag, a changed one, only a date, or no validator at all."""
    page = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    c = F.conv(F.substring(F.md5("url"), 1, 7), 16, 10).cast("long")
    page = page.withColumns({"c": c, "tag": F.md5("html"), "t": F.lit(1_700_000_000) + F.pmod(c, F.lit(2_592_000)) + F.pmod("page_id", F.lit(7))})
    date = F.concat(F.lit("Day "), F.floor(F.col("t") / 86_400).cast("string"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    full = F.concat(line("ETag", F.concat(F.lit('"'), "tag", F.lit('"'))), line("Last-Modified", date),
                    line("Content-Type", F.lit("text/html")), line("Cache-Control", F.lit("max-age=60")),
                    line("Content-Length", F.length("html").cast("string")))
    case = F.pmod("c", F.lit(5))
    check = (F.when(case <= 1, line("ETag", F.concat(F.lit('W/"'), "tag", F.lit('"'))))
             .when(case == 2, line("ETag", F.lit('"changed"'))).when(case == 3, line("Last-Modified", date)).otherwise(""))
    again = F.concat(check, line("Cache-Control", F.lit("max-age=600")), line("Content-Length", F.lit("0")),
                     line("Expires", F.concat(F.lit("in "), F.pmod("c", F.lit(90)).cast("string"), F.lit(" days"))))
    later = F.col("t") + F.pmod("c", F.lit(400_000)) - 20_000      # some come before the response
    records = F.array(F.struct((2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("t").alias("s"), full.alias("headers")),
                      F.struct((2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", later.alias("s"), again.alias("headers")))
    return page.select(F.explode(records).alias("r")).select("r.*").withColumn("time", F.timestamp_seconds("s")).drop("s")


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.warc import resolve_revisits

    out = resolve_revisits(_captures(spark, sf_dir))
    listed = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select("record_id", "url_key", F.unix_timestamp("time").alias("seconds"), "status", "response_id",
                      F.unix_timestamp("response_time").alias("response_seconds"), F.array_join(listed, "; ").alias("headers"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.license import scan

    docs = _documents(spark, sf_dir).select("doc_id", "text", "source")
    folder = F.floor(F.col("doc_id") / 64).cast("string")
    files = docs.select("doc_id", "text", F.concat("source", F.lit("/"), F.floor(F.col("doc_id") / 1024).cast("string"), F.lit("/"),
                                                   folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    out = scan(files, "doc_id", "path", "text")
    return out.select("doc_id", "path", "license", F.round("cosine", 6).alias("cosine"), "origin")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.collocations import collocations

    return collocations(_documents(spark, sf_dir).select("text", "lang"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from candlewick.llm.alignment import align

    out = align(_documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return out.withColumn("groups_sha256", digest).drop("groups")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from candlewick.llm.pieces import piece_encode

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    coded = piece_encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded="text")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language_id": op6_language_id,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_license_scan": op8_license_scan,
    "op9_hilbert_packing": op9_hilbert_packing,
    "op10_graph_neighbours": op10_graph_neighbours,
    "op11_collocations": op11_collocations,
    "op12_token_alignment": op12_token_alignment,
    "op13_sentencepiece": op13_sentencepiece,
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
OP2_SQL = rf"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
t AS (SELECT k, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM g),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM t) WHERE n >= 2),
p AS (SELECT k, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) v(o) GROUP BY k),
c AS (SELECT w.k, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
      FROM w LEFT JOIN p ON w.k = p.k),
f AS (SELECT *, n_words < 50 AS r1, 100 * n_repeat_words > 50 * n_words AS r2, 100 * n_symbols > 30 * n_words AS r3,
             100 * n_dup_lines > 50 * n_lines AS r4 FROM c),
u AS (UNPIVOT (SELECT source, r1::INT AS r1, r2::INT AS r2, r3::INT AS r3, r4::INT AS r4, (r1 OR r2 OR r3 OR r4)::INT AS r0
               FROM f WHERE source IS NOT NULL) ON r0, r1, r2, r3, r4 INTO NAME rule VALUE bad),
h AS (SELECT source, rule, count(*) AS n, sum(bad) AS s FROM u GROUP BY ALL),
m AS (SELECT rule, sum(s) / sum(n) AS mean, sum(s * s / n) / sum(n) - (sum(s) / sum(n)) ** 2 AS var FROM h GROUP BY rule),
k AS (SELECT rule, mean, CASE WHEN var * 1e6 <= mean * (1 - mean) THEN 1e6
                              ELSE greatest(mean * (1 - mean) / var - 1, 1.0) END AS k FROM m),
a AS (SELECT *, (s + mean * k) / (n + k) AS post FROM h JOIN k USING (rule)),
v AS (SELECT source, max(post) FILTER (rule <> 'r0') AS rate, any_value(mean) FILTER (rule = 'r0') AS peers,
             any_value(post - sqrt(post * (1 - post) / (n + k + 1))) FILTER (rule = 'r0') AS bound FROM a GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
       round(rate, 6) AS host_rate, round(bound, 6) AS host_bound, bound > peers AS host_worse,
       NOT (r1 OR r2) AND NOT coalesce(rate > 0.75, false) AND NOT ((r3 OR r4) AND coalesce(bound > peers, false)) AS kept
FROM f LEFT JOIN v ON f.source = v.source
"""

OP7_SQL = r"""
WITH p AS (SELECT page_id, url, html, c, md5(html) AS tag, 1700000000 + c % 2592000 + page_id % 7 AS t
           FROM (SELECT *, ('0x' || substr(md5(url), 1, 7))::BIGINT AS c FROM pages)),
q AS (SELECT *, 'Day ' || (t // 86400) AS date, t + c % 400000 - 20000 AS later,
             lower(regexp_extract(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^([^/?]*)', 1)) AS host,
             regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM p),
k AS (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www[.]', '') || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
             list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
                                   lambda x: x <> '' AND NOT regexp_matches(x, '^(?i:utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS args FROM q),
u AS (SELECT *, path || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS url_key FROM k),
r AS (SELECT v.page_id, v.url_key, v.later, v.c, v.tag AS vtag, v.date AS vdate, f.page_id AS fid, f.t AS ft, f.tag AS ftag, f.date AS fdate, f.html AS fhtml,
             row_number() OVER (PARTITION BY v.page_id ORDER BY f.t DESC NULLS LAST, f.page_id DESC) AS n
      FROM u v LEFT JOIN u f ON f.url_key = v.url_key AND f.t < v.later),
s AS (SELECT *, CASE WHEN fid IS NULL THEN 'no_earlier_response' WHEN c % 5 <= 1 THEN CASE WHEN vtag = ftag THEN 'resolved' ELSE 'validator_mismatch' END
                     WHEN c % 5 = 2 THEN 'validator_mismatch' WHEN c % 5 = 3 THEN CASE WHEN vdate = fdate THEN 'resolved' ELSE 'validator_mismatch' END
                     ELSE 'no_validator' END AS status FROM r WHERE n = 1)
SELECT 2 * page_id + 1 AS record_id, url_key, later AS seconds, status, CASE WHEN status = 'resolved' THEN 2 * fid END AS response_id,
       CASE WHEN status = 'resolved' THEN ft END AS response_seconds,
       CASE WHEN status = 'resolved' THEN 'cache-control=max-age=600; content-length=' || length(fhtml) || '; content-type=text/html; etag='
            || CASE WHEN c % 5 <= 1 THEN 'W/' ELSE '' END || '"' || ftag || '"; expires=in ' || (c % 90) || ' days; last-modified=' || fdate END AS headers
FROM s
"""

OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, 1 AS m, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) >= 2
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) >= 3),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS x, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
k AS (SELECT lang, m, phrase, x, f, unnest(range(1, m)) AS k FROM c WHERE m >= 2),
s AS (SELECT k.lang, k.phrase, k.f AS a, k.k, l.f AS l, r.f AS r,
             ((1000000::HUGEINT * k.f * k.f) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM k JOIN c l ON l.lang = k.lang AND l.phrase = array_to_string(k.x[1:k.k], ' ')
             JOIN c r ON r.lang = k.lang AND r.phrase = array_to_string(k.x[k.k + 1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s) WHERE o = 1),
e AS (SELECT lang, part, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(x[1:2], ' '), array_to_string(x[2:3], ' ')]) AS part FROM c WHERE m = 3) GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM b LEFT JOIN e ON e.lang = b.lang AND e.part = b.phrase WHERE NOT coalesce(100 * e.f >= 50 * a, false))
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


def _op8_sql() -> str:
    from candlewick.llm.license import TEMPLATES

    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    return rf"""
WITH t(license, txt) AS (VALUES {rows}),
tw AS (SELECT license, w, count(*) AS n FROM (SELECT license, unnest(regexp_extract_all(lower(txt), '[a-z0-9]+')) AS w FROM t) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
             source || '/' || doc_id // 1024 || '/' || doc_id // 64 AS dir FROM documents),
f AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT k, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM d) GROUP BY w),
n AS (SELECT count(*) AS n FROM d),
idf AS (SELECT w, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT w FROM f UNION SELECT w FROM tw) LEFT JOIN f USING (w), n),
v AS (SELECT license, w, tw.n * idf AS x FROM tw JOIN idf USING (w)),
share AS (SELECT license, w, x * idf / sqrt(sum(x * x) OVER (PARTITION BY license)) AS x FROM v JOIN idf USING (w)),
u AS (SELECT k, 0 AS whole, unnest(string_split(text, chr(10))) AS unit FROM d
      UNION ALL SELECT k, 0, unnest(regexp_split_to_array(text, '
[ 	
]*
')) FROM d
      UNION ALL SELECT k, 1, text FROM d),
h AS (SELECT row_number() OVER () AS i, * FROM (SELECT DISTINCT * FROM u)),
tf AS (SELECT i, w, count(*) AS n FROM (SELECT i, unnest(regexp_extract_all(lower(unit), '[a-z0-9]+')) AS w FROM h) GROUP BY ALL),
m AS (SELECT i, sqrt(sum((n * idf) ** 2)) AS norm FROM tf JOIN idf USING (w) GROUP BY i),
c AS (SELECT i, license, round(sum(n * x) / any_value(norm), 9) AS cosine FROM tf JOIN share USING (w) JOIN m USING (i) GROUP BY ALL),
s AS (SELECT k, whole, license, cosine FROM c JOIN h USING (i)),
own AS (SELECT k, license, cosine FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY cosine DESC, license) AS r FROM s WHERE cosine >= 0.8) WHERE r = 1),
holders AS (SELECT dir, license, cosine FROM (SELECT dir, license, cosine, row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license) AS r
            FROM s JOIN d USING (k) WHERE whole = 1 AND cosine >= 0.6 AND dir IS NOT NULL) WHERE r = 1),
near AS (SELECT k, license, cosine FROM (SELECT d.k, holders.license, cosine, row_number() OVER (PARTITION BY d.k ORDER BY length(holders.dir) DESC) AS r
         FROM d JOIN holders ON d.dir = holders.dir OR starts_with(d.dir, holders.dir || '/')) WHERE r = 1)
SELECT doc_id, dir || '/' || doc_id || '.txt' AS path, coalesce(own.license, near.license) AS license,
       round(coalesce(own.cosine, near.cosine), 6) AS cosine,
       CASE WHEN own.k IS NOT NULL THEN 'own' WHEN near.k IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin
FROM d LEFT JOIN own USING (k) LEFT JOIN near USING (k)
"""


ORACLES: dict[str, str] = {
    "op2_quality_rules": OP2_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op8_license_scan": _op8_sql(),
    "op11_collocations": OP11_SQL,
}
