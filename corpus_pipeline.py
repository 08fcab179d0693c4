"""A corpus from raw documents to packed training sequences.

Quality, language, near duplicates, repeated passages, packing: each stage works on what the
one before it kept, and reads it from a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import folds, jaccard, language, packing, quality, substring
from shelfcast.llm.queries import ready, tokenizer_path
from shelfcast.operators.skew import lookup
from shelfcast.settings import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Score from which a document stays; words of a shingle and percent of similarity of near
# duplicates; words of a repeated passage.
MIN_QUALITY, SHINGLE, PERCENT, PASSAGE = 0.7, 5, 80, 50


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote scores at least ``MIN_QUALITY``.

    Null and empty texts score the share of good labels; null and repeated ids stay as they are; whole
    texts count, however long; an empty table stays empty.
    """
    ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(folds.labelled(docs, labels, "quality", 4, 2))
    return quality.score(docs.select(*COLUMNS), model, "_score").filter(F.col("_score") >= MIN_QUALITY).select(*COLUMNS)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier can place.

    Those without any letter or text go, and those much farther from every language, or nearer to a
    tie between languages, than labelled texts of their size (``language.limits``).
    """
    ready(spark)
    learn = docs.filter(F.col("doc_id").isNotNull() & ~folds.held_out("doc_id", 4, 2))
    model = language.fit(learn)
    least = language.limits(learn, model)
    found = language.predict(docs.select(*COLUMNS), model, "_lang", "_sure", more=("_near", "_letters"))
    return found.filter(language.placed(least, "_lang", "_sure", "_near", "_letters")).select(*COLUMNS)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Rows without an id, and different texts under one id, get a number of their own from id and text,
    above all others, for as long as this takes. So unrelated texts that share an id all stay; rows that
    repeat id and text are one document. Texts without words belong to no group. Whole texts count,
    however long; an empty table stays empty.
    """
    ready(spark)
    mark = F.xxhash64("text").alias("_mark")
    shared = docs.filter("doc_id is not null").select("doc_id", mark).groupBy("doc_id").agg(F.min("_mark").alias("_a"), F.max("_mark").alias("_b"))
    shared = lookup(shared.filter("_a <> _b").select("doc_id", F.lit(True).alias("_shared")), "shared-ids")
    own = F.xxhash64("doc_id", "text").bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
    named = docs.select(*COLUMNS).join(shared, "doc_id", "left")
    named = named.select(*COLUMNS, F.when(F.col("_shared") | F.col("doc_id").isNull(), own).otherwise(F.col("doc_id")).alias("_id"))
    groups = jaccard.similar_groups(named, SHINGLE, PERCENT, id_col="_id")
    gone = groups.filter("id <> component_id").select(F.col("id").alias("_id")).distinct()
    return named.join(gone, "_id", "left_anti").dropDuplicates(["_id"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` words or more that stand elsewhere too leave every text.

    Null texts become empty; rows that repeat a text lose what they share; null and repeated ids stay;
    whole texts count, however long; an empty table stays empty.
    """
    ready(spark)
    found = substring.remove_repeats(docs, PASSAGE, as_is=True, carry=("lang", "source"))
    return found.select(F.col("id").alias("doc_id"), F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids whose lengths are powers of two.

    Null and empty texts give their end token; null and repeated ids stay, one document per row; whole
    texts count, however long; an empty table gives none.
    """
    ready(spark)
    return packing.pack(docs, tokenizer_path(), 1024).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("n-gram Jaccard join", keep_distinct),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

# Classifiers and tokenizers cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
