"""License scan: sparse TF-IDF cosine to templates, then nearest-ancestor
directory inheritance.

1. Document frequencies of all words, over all files, give idf: a written
   table, of which only the templates' words are collected.
2. Units of a file are compared with every template: each line and each
   paragraph (headers) and the whole file (a licence file).  A unit's vector
   has a dimension for each of its words, whose idf it gets by a join with
   that table.  Only units that hold a telling word
   can reach the threshold: the words left out carry so little of any
   template's norm that without a telling word no cosine gets there.
3. A file's own licence is its best template at or above ``HEADER_COSINE``.
   A file whose whole text reaches ``FILE_COSINE`` is its directory's
   licence.  Other files inherit from the nearest ancestor directory that
   has one; directories, not files, climb the tree, so a directory with a
   third of all files is resolved once.

Ties: larger cosine, then the template that comes first by name, then the
smaller path.  Null text: no licence of its own.  Null path: nothing to
inherit.  Repeated rows stay.  An empty table gives an empty table.  Only
the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import save

#: Short notices by which files say their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
HEADER_COSINE, FILE_COSINE = 0.8, 0.6


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def _counts(templates: dict[str, str]) -> dict[str, dict[str, int]]:
    import re

    out = {}
    for name, text in templates.items():
        words = re.findall("[a-z0-9]+", text.lower())
        out[name] = {w: words.count(w) for w in words}
    return out


def telling_words(weights: dict[str, dict[str, float]], cosine: float) -> list[str]:
    """The fewest words of largest weight without which the rest of each
    template's norm stays below ``cosine``."""
    chosen: set[str] = set()
    for vector in weights.values():
        rest = sum(w * w for w in vector.values())
        limit = (0.99 * cosine) ** 2 * rest
        for word, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < limit:
                break
            chosen.add(word)
            rest -= w * w
    return sorted(chosen)


def scan(files: DataFrame, key: str, path: str, text: str, templates: dict[str, str] | None = None,
         header: float = HEADER_COSINE, whole: float = FILE_COSINE) -> DataFrame:
    """(key, path, license, cosine, origin): origin is ``own``, ``inherited``
    (cosine of the licence file) or ``none``."""
    counts = _counts(templates or TEMPLATES)
    words = sorted({w for v in counts.values() for w in v})
    body = files.select(F.col(key).alias("_key"), F.col(path).alias("_path"), F.col(text).alias("_text"))

    found = body.select(F.explode(F.array_distinct(tokens(F.coalesce("_text", F.lit(""))))).alias("_w"))
    df = save(found.groupBy("_w").agg(F.count(F.lit(1)).alias("_df")), "license-words").df
    freq = {r["_w"]: r["_df"] for r in df.where(F.col("_w").isin(words)).collect()}     # at most one row per template word
    n = body.count()
    idf = {w: math.log((1 + n) / (1 + freq.get(w, 0))) + 1 for w in words}
    all_idf = df.select("_w", (F.log((1 + F.lit(n)) / (1 + F.col("_df"))) + 1).alias("_idf"))
    weights = {name: {w: c * idf[w] for w, c in v.items()} for name, v in counts.items()}
    telling = "|".join(telling_words(weights, min(header, whole)))

    texts = body.where(F.lower("_text").rlike(rf"(?<![a-z0-9])({telling})(?![a-z0-9])"))
    units = F.concat(
        F.transform(F.split("_text", "\n"), lambda x: F.struct(F.lit(0).alias("whole"), x.alias("unit"))),
        F.transform(F.split("_text", r"\n[\x20\t\r]*\n"), lambda x: F.struct(F.lit(0).alias("whole"), x.alias("unit"))),
        F.array(F.struct(F.lit(1).alias("whole"), F.col("_text").alias("unit"))))
    rows = (texts.select("_key", "_path", F.explode(units).alias("u")).select("_key", "_path", "u.whole", "u.unit")
            .where(F.lower("unit").rlike(rf"(?<![a-z0-9])({telling})(?![a-z0-9])")))
    rows = rows.withColumn("_unit", F.md5("unit"))
    best = _best(rows.dropDuplicates(["_unit"]).select("_unit", "unit"), weights, idf, all_idf)
    scored = rows.select("_key", "_path", "whole", "_unit").join(best, "_unit").where(F.col("s.cosine") >= min(header, whole))
    scored = save(scored.drop("_unit"), "license-units").df

    # equal (key, path) rows have equal texts in a table of files; they share an answer
    own = (scored.where(F.col("s.cosine") >= header).groupBy("_key", "_path").agg(F.max("s").alias("s")))
    holders = scored.where((F.col("whole") == 1) & (F.col("s.cosine") >= whole) & F.col("_path").isNotNull())
    first = Window.partitionBy("_dir").orderBy(F.desc("s.cosine"), F.desc("s.order"), "_path")
    per_dir = (holders.withColumn("_dir", directory(F.col("_path"))).withColumn("_r", F.row_number().over(first))
               .where("_r = 1").select("_dir", F.col("s").alias("_ds")))

    dirs = body.where(F.col("_path").isNotNull()).select(directory(F.col("_path")).alias("_of")).distinct()
    climbed = dirs.select("_of", F.posexplode(ancestors(F.col("_of"))).alias("_up", "_dir"))
    nearest = (climbed.join(per_dir, "_dir").groupBy("_of").agg(F.min_by("_ds", "_up").alias("_ds")))

    files_ = body.select("_key", "_path").withColumn("_of", directory(F.col("_path")))
    same = lambda a, b: a["_key"].eqNullSafe(b["_key"]) & a["_path"].eqNullSafe(b["_path"])
    out = files_.join(own, same(files_, own), "left").select(files_["_key"], files_["_path"], "_of", "s").join(nearest, "_of", "left")
    best = F.coalesce("s", "_ds")
    return out.select(F.col("_key").alias(key), F.col("_path").alias(path), best["license"].alias("license"), best["cosine"].alias("cosine"),
                      F.when(F.col("s").isNotNull(), "own").when(F.col("_ds").isNotNull(), "inherited").otherwise("none").alias("origin"))


def _best(units: DataFrame, weights: dict[str, dict[str, float]], idf: dict[str, float], all_idf: DataFrame) -> DataFrame:
    """(_unit, s): each distinct unit's best template, by a join of the sparse
    vectors on their words; every word of a unit has its own idf in the norm."""
    spark = units.sparkSession
    # one row per template word: as bounded as the templates
    entry = [F.struct(F.lit(-i).alias("order"), F.lit(name).alias("license"), F.lit(w).alias("_w"),
                      F.lit(x * idf[w] / math.sqrt(sum(y * y for y in v.values()))).alias("share"))
             for i, (name, v) in enumerate(sorted(weights.items())) for w, x in v.items()]
    table = F.broadcast(spark.range(1).select(F.inline(F.array(*entry))))
    tf = units.select("_unit", F.explode(tokens(F.col("unit"))).alias("_w"))
    # units are texts of the files, so the table has each of their words
    tf = tf.groupBy("_unit", "_w").agg(F.count(F.lit(1)).alias("_n")).join(all_idf, "_w")
    norm = F.sqrt(F.sum(F.pow(F.col("_n") * F.col("_idf"), 2)).over(Window.partitionBy("_unit")))
    dots = tf.withColumn("_norm", norm).join(table, "_w").groupBy("_unit", "order", "license").agg(
        (F.sum(F.col("_n") * F.col("share")) / F.first("_norm")).alias("cosine"))
    return dots.groupBy("_unit").agg(F.max(F.struct(F.round("cosine", 9).alias("cosine"), "order", "license")).alias("s"))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The folder and those above it, up to the root (empty), nearest first."""
    names = F.split(folder, "/")
    deep = F.when(folder == "", 0).otherwise(F.size(names))
    return F.transform(F.sequence(F.lit(0), deep), lambda i: F.array_join(F.slice(names, 1, deep - i), "/"))
