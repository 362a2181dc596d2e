"""Host-level quality rules (DataFrame functions only).

1. ``document_rules`` counts, in one pass over each text, what the rules
   need and says which rules the document fails.
2. ``host_verdicts`` sums failures by host and rule, fits one beta prior per
   rule to the failure rates of all hosts (method of moments, weighted by
   documents) and shrinks each host's rate towards it, so that a host with
   three documents is not judged by three documents.
   A host is worse than its peers if its posterior rate of failing any rule,
   less ``PEER_DEVIATIONS`` posterior deviations, is above the prior's mean.
3. ``quality_rules`` joins the verdicts back: a document is kept if it
   passes the base rules, its host is not rejected and, should it fail
   ``symbols`` or ``dup_lines``, its host is no worse than its peers.

Null text: no words, so ``too_short``.  Null host: no verdict, the base
rules alone decide.  Repeated rows stay, each with the same verdict.  An
empty table gives an empty table.  Added columns start with ``_q_``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.session import save

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50      # of words, in 3-word windows found twice or more
MAX_SYMBOL_PERCENT = 30      # symbols per word
MAX_DUP_LINE_PERCENT = 50    # of lines with a word
MAX_HOST_RATE = 0.75         # shrunk failure rate from which a host is rejected
PEER_DEVIATIONS = 1.0        # of the posterior, by which a worse host's rate lies above its peers'
#: Strength of the prior when all hosts fail at the same rate (or nearly so).
MAX_PRIOR = 1e6

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
RULES = ("too_short", "repetitive", "symbols", "dup_lines")
ANY = "any"
COUNTS = ("_q_words", "_q_chars", "_q_symbols", "_q_lines", "_q_dup_lines", "_q_repeat_words")


def _repeat_words(words: str) -> tuple[dict[str, Column], Column]:
    """Words covered by a 3-word window that the text holds twice or more.

    A text without equal windows is done after counting the distinct hashes.
    Else windows are sorted by hash and compared with their neighbours; the
    repeated starts, in text order, cover 3 words each, less the overlap.
    """
    steps = {
        "_q_h": F.expr(f"transform(if(size({words}) >= 3, sequence(0, size({words}) - 3), array()),"
                       f" i -> xxhash64(get({words}, i), get({words}, i + 1), get({words}, i + 2)))"),
        "_q_s": F.expr("if(size(array_distinct(_q_h)) = size(_q_h), array(),"
                       " sort_array(transform(_q_h, (h, i) -> struct(h as h, i as i))))"),
        "_q_p": F.expr("if(size(_q_s) = 0, array(), sort_array(transform(filter(transform(_q_s, (x, j) ->"
                       " struct(x.i as i, x.h <=> get(_q_s, j - 1).h or x.h <=> get(_q_s, j + 1).h as r)),"
                       " x -> x.r), x -> x.i)))"),
    }
    # least() skips the null after the last start, which so counts 3
    covered = F.expr("aggregate(transform(_q_p, (p, j) -> cast(least(3, get(_q_p, j + 1) - p) as bigint)),"
                     " 0L, (a, x) -> a + x)")
    return steps, covered


def document_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts (``COUNTS``) and one boolean per rule (``_q_<rule>``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_q_w", F.filter(F.split(body, WORD_BREAK), lambda x: x != ""))
    df = df.withColumn("_q_l", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    steps, covered = _repeat_words("_q_w")
    for name, col in steps.items():
        df = df.withColumn(name, col)
    df = df.withColumns({
        "_q_words": F.size("_q_w").cast("long"),
        "_q_chars": F.length(F.array_join("_q_w", "")).cast("long"),
        "_q_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long"),
        "_q_lines": F.size("_q_l").cast("long"),
        "_q_dup_lines": (F.size("_q_l") - F.size(F.array_distinct("_q_l"))).cast("long"),
        "_q_repeat_words": covered,
    }).drop("_q_w", "_q_l", *steps)
    c = F.col
    return df.withColumns({
        "_q_too_short": c("_q_words") < MIN_WORDS,
        "_q_repetitive": 100 * c("_q_repeat_words") > MAX_REPEAT_PERCENT * c("_q_words"),
        "_q_symbols_rule": 100 * c("_q_symbols") > MAX_SYMBOL_PERCENT * c("_q_words"),
        "_q_dup_lines_rule": 100 * c("_q_dup_lines") > MAX_DUP_LINE_PERCENT * c("_q_lines"),
    })


_FLAGS = {"too_short": "_q_too_short", "repetitive": "_q_repetitive",
          "symbols": "_q_symbols_rule", "dup_lines": "_q_dup_lines_rule"}


def host_verdicts(scored: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per (non-null) host: documents, shrunk failure rate by rule,
    whether the host is rejected and whether it is worse than its peers."""
    n = F.col("_q_n")
    fails_any = reduce(or_, [F.col(flag) for flag in _FLAGS.values()])
    hosts = (scored.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("_q_host"))
             .agg(F.count(F.lit(1)).alias("_q_n"),
                  *[F.sum(F.col(flag).cast("long")).alias(f"_q_f_{r}") for r, flag in _FLAGS.items()],
                  F.sum(fails_any.cast("long")).alias(f"_q_f_{ANY}")))
    rates, priors = [], _priors(hosts, (*RULES, ANY))
    for rule, (mean, k) in priors.items():
        rates.append(((F.col(f"_q_f_{rule}") + F.lit(mean * k)) / (n + F.lit(k))).alias(f"_q_rate_{rule}"))
    judged = hosts.select("_q_host", n, *rates)
    worst = F.greatest(*[F.col(f"_q_rate_{r}") for r in RULES])
    mean, k = priors[ANY]
    rate = F.col(f"_q_rate_{ANY}")
    bound = rate - F.lit(PEER_DEVIATIONS) * F.sqrt(rate * (1 - rate) / (n + F.lit(k + 1)))
    return judged.withColumns({"_q_host_rate": worst, "_q_host_rejected": worst > max_rate,
                               "_q_host_bound": bound, "_q_host_worse": bound > mean})


def _priors(hosts: DataFrame, rules: Sequence[str] = RULES) -> dict[str, tuple[float, float]]:
    """Mean and strength k of each rule's prior beta(mean * k, (1 - mean) * k),
    whose variance is mean * (1 - mean) / (k + 1): one row of sums."""
    sums = hosts.agg(
        F.sum("_q_n").alias("n"), *[F.sum(f"_q_f_{r}").alias(f"t_{r}") for r in rules],
        *[F.sum(F.col(f"_q_f_{r}") * F.col(f"_q_f_{r}") / F.col("_q_n")).alias(f"ss_{r}") for r in rules]).first()
    out = {}
    for r in rules:
        mean = (sums[f"t_{r}"] or 0) / (sums["n"] or 1)
        spread, var = mean * (1 - mean), (sums[f"ss_{r}"] or 0.0) / (sums["n"] or 1) - mean * mean
        out[r] = (mean, MAX_PRIOR if var * MAX_PRIOR <= spread else max(spread / var - 1, 1.0))
    return out


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text",
                  max_rate: float = MAX_HOST_RATE, drop_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (less the text on request) with the counts, the
    rules, ``_q_host_rate``, ``_q_host_bound``, ``_q_host_worse``,
    ``_q_base_failed`` and ``_q_kept``.

    The counts are written once to the shared folder, as both the sums by
    host and the join back read them.
    """
    scored = document_rules(docs, text)
    scored = save(scored.drop(text) if drop_text else scored, "quality").df
    # written, so that its size is known: documents are only shuffled by host if there are very many hosts
    hosts = save(host_verdicts(scored, host, max_rate).select(
        "_q_host", "_q_host_rate", "_q_host_rejected", "_q_host_bound", "_q_host_worse"), "hosts").df
    out = scored.join(hosts, F.col(host) == F.col("_q_host"), "left").drop("_q_host")
    base = F.col("_q_too_short") | F.col("_q_repetitive")
    doubtful = F.col("_q_symbols_rule") | F.col("_q_dup_lines_rule")
    no = F.lit(False)
    return out.withColumns({
        "_q_base_failed": base,
        "_q_kept": ~base & ~F.coalesce("_q_host_rejected", no) & ~(doubtful & F.coalesce("_q_host_worse", no)),
    })
