"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``:

1. quality rules: documents that fail the base rules, or whose host is
   rejected, go;
2. language ID: documents without a letter, or whose language is not told
   with ``MIN_SCORE``, go;
3. n-gram Jaccard join: of each group of near copies the one with the most
   shingles stays (ties: the smallest id); rows without an id stay;
4. suffix-array dedup: passages of 50 words or more that an earlier document
   has are cut out; a document left without a word goes;
5. packing: what is left becomes token sequences along the Hilbert curve.

All but the last return the columns of ``documents``.  Repeated rows (equal
id and text) are one document from stage 3 on.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.session import save

#: Least probability of the told language; with four languages chance is 0.25.
MIN_SCORE = 0.4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from candlewick.llm.quality import quality_rules

    return quality_rules(docs).where("_q_kept").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from candlewick.llm.langid import UND, fit_language_model, held_out, identify_language

    model = fit_language_model(docs, ~held_out(F.col("doc_id")))
    out = identify_language(docs, model, out="_lang", score="_score")
    # without labels nothing is told, and nothing is rejected for it
    told = (F.col("_lang") != UND) & (F.col("_score") >= MIN_SCORE) if model else F.col("text").rlike(r"\p{L}")
    return out.where(told).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from candlewick.llm.jaccard import jaccard_join

    groups = jaccard_join(docs).where("doc_id is not null").select(F.col("doc_id").alias("_id"), "n_shingles", "component_id")
    # one winner per group is an aggregate with partial sums: a group of any size is no window
    best = groups.groupBy("component_id").agg(F.min(F.struct(-F.col("n_shingles"), "_id")).alias("b")).select("b._id").distinct()
    rows = groups.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows"))
    kept = docs.join(best.join(rows, "_id"), F.col("doc_id") == F.col("_id")).drop("_id")
    # only ids that several rows have need their rows side by side
    once = Window.partitionBy("doc_id").orderBy(F.md5(F.coalesce("text", F.lit(""))), "source", "lang")
    many = kept.where("_rows > 1").withColumn("_r", F.row_number().over(once)).where("_r = 1")
    out = kept.where("_rows = 1").select(docs.columns).unionByName(many.select(docs.columns))
    return out.unionByName(docs.where("doc_id is null"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from candlewick.llm.suffixes import remove_passages

    out = remove_passages(docs, min_words=50)
    cut = F.col("n_removed") > 0
    out = out.where(~cut | (F.col("n_removed") < F.col("n_words")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from candlewick.llm.packing import pack

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", passages),
    ("packing", packing),
]
#: A trained network and a tokenizer are stages: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``; every stage is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}").df
    return docs
