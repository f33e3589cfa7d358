"""One query for each operator, over its whole table, and the same in SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.llm import chat, codes, contamination, lines, minhash, ngram_lm, pieces, quality, repeats, secrets, simhash, token_counts, whitening
from lethe.llm.frames import pick, table
from lethe.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept"
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents")).withColumn(
        "dropped", F.array_join(F.transform("dropped", lambda i: i.cast("string")), ",")
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    own = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    formatted = chat.render(chat.canonical_turns(rows.union(spark.createDataFrame(own, rows.schema))))
    turns = F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.withColumn("__turns", chat.read_back(F.col("formatted")))
        .withColumn("__loss", chat.loss_text(F.col("formatted"), F.col("mask")))
        .select(
            "conv_id",
            F.size("__turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
            F.length("__loss").cast("long").alias("loss_chars"),
            F.sha2("__loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), F.round("shared", 6).alias("shared"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.encode(table(spark, sf_dir, "documents"), model)
    return found.select(
        "doc_id",
        "n_bytes",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "lossless",
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_lm.score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("score", 3).alias("score"), F.round("mean", 5).alias("mean"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_quality_rules,
        op3_line_dedup,
        op4_simhash_near_dedup,
        op5_suffix_array_dedup,
        op6_chat_formatting,
        op7_benchmark_decontamination,
        op8_sentencepiece,
        op9_token_counts,
        op10_lm_scoring,
        op11_embedding_whitening,
        op12_vector_codes,
        op13_minhash_near_dedup,
    )
}
