"""The registered queries: thin contracts over the operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    align, bpe, embeddings, folds, jaccard, language, language_model, packing, quality, rules, spelling, substring, toxicity, urls,
)
from shelfcast.llm.oracles import SPELLING_SQL, url_sql

TOKENIZER, OTHER_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = (
    urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow"),
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ready(spark: SparkSession) -> None:
    """Let this machine's Python workers import the package (a cluster has it installed)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(p for p in (root, env.get("PYTHONPATH", "")) if p)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.similar_groups(table(spark, folder, "documents"), size=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def _crc(lists: pa.Array) -> pa.Array:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    at = (lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()) * 4
    return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())], pa.int64())


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer_path())

    def digest(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _crc(batch.column(6)), *batch.columns[3:6]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return pieces.mapInArrow(
        digest, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, folder, "documents"), size=35, digests=True)
    return found.withColumnRenamed("id", "doc_id")


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = embeddings.near_groups(table(spark, folder, "embeddings"), threshold=0.98)
    return found.withColumnRenamed("id", "vec_id")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(folds.labelled(docs, labels, "quality", 4, 2))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", folds.held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(folds.labelled(docs, labels, "toxic", 5, 0))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", folds.held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.apply_rules(table(spark, folder, "documents").select("doc_id", "text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"),
    )


def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    found = language_model.score(table(spark, folder, "documents"), folds.held_out("doc_id", 10, 0))
    return found.withColumnRenamed("id", "doc_id")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learn = docs.filter(F.col("doc_id").isNotNull() & ~folds.held_out("doc_id", 4, 2))
    found = language.predict(docs.select("doc_id", "text"), language.fit(learn))
    return found.select("doc_id", folds.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe.encode(table(spark, folder, "documents"), tokenizer_path(), digests=True)
    return found.withColumnRenamed("id", "doc_id")


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"), least_letters=5, least_uses=3, noise=97)


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = align.align(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path(OTHER_TOKENIZER))
    return found.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_packing, op3_substring_dedup, op4_embedding_dedup, op5_quality, op6_toxicity,
        op7_quality_rules, op8_lm_score, op9_language, op10_bpe, op11_url_filter, op12_spelling, op13_token_alignment,
    )
}
ORACLE_SQL: dict[str, str] = {"op11_url_filter": url_sql(URL_RULES), "op12_spelling": SPELLING_SQL}
