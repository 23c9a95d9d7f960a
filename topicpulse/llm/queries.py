"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from topicpulse.llm import (bpe, exact_dedup, fingerprints, periodic_runs, prefix_trie, html_extract, line_dedup, lm_score, near_dedup, packing, quality,
                            substring_dedup, token_counts)
from topicpulse.llm.common import documents
from topicpulse.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *quality.BASE, "kept")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document that repeats a passage: the removed spans and the documents that keep them."""
    return substring_dedup.passages(documents(spark, sf_dir)).select(
        "doc_id", "spans", "kept_in", F.size("spans").cast("long").alias("n_removed"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), "text")


def planted_words(docs: DataFrame) -> DataFrame:
    """doc_id and ``words``: words ``[^\\x20\\x09-\\x0D]+`` of the text; in every tenth document (by crc32 of
    its id) the words from position a on repeat the stretch of p words at a."""
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = docs.select("doc_id", words.alias("_w"))  # a column of its own: the rewrite below reads it per word
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("_w")
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    planted = F.transform("_w", lambda w, i: F.when(i >= F.col("_a"), F.element_at(
        F.col("_w"), (F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")) + 1).cast("int"))).otherwise(w))
    return (split.withColumn("_a", a).withColumn("_p", p)
            .select("doc_id", F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), planted).otherwise(F.col("_w"))
                    .alias("words")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_words(documents(spark, sf_dir))
    found = periodic_runs.periodic_runs(docs, "doc_id", "words")
    spec = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                                F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(spec, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(convs)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_html_extraction, op3_simhash_near_dedup, op4_quality_rules, op5_best_fit_packing, op6_token_counts,
    op7_document_fingerprints, op8_substring_dedup, op9_lm_scoring, op10_line_dedup, op11_periodic_runs, op12_exact_dedup, op13_prefix_trie)}
QUERIES["pipeline"] = corpus_pipeline.run
