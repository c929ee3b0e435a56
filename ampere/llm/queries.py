"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm import (byte_bpe, centroids, context_tree, jaccard_join, line_runs, mixing, nn_descent, quality_rules, repair,
                        secret_scan, spelling, suffix_groups, toxicity)
from ampere.llm.common import Scratch, read
from ampere.llm.sql import ORACLE  # noqa: F401


def op8_line_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.clean_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pre-token pattern of the public tokenizer used."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digests(docs: DataFrame) -> DataFrame:
    path, pattern = vocabulary()
    coded = byte_bpe.encode(docs.select("doc_id", "text"), path, pattern).select(
        "doc_id", F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return byte_bpe.decode(coded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("raw", 256).alias("decoded_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"))


def op1_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.plan(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op3_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.fold(F.col("doc_id"), 4) == 2
    labels = read(spark, sf_dir, "labels").filter(~held_out)
    model = toxicity.learn(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_context_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.fold(F.col("doc_id"), 7) == 2
    return context_tree.score(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "n_bytes")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_groups.remove(docs, digest=True).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.remove(docs).select(
        "doc_id", "deleted_lines", F.sha2("text", 256).alias("kept_sha256"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nn_descent.search(vectors, F.col("vec_id") % 20 == 0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secret_scan.scan(docs, lambda id: toxicity.fold(id, 4) != 2, path="source")
    return found.select(
        "doc_id", "start", F.length("value").cast("long").alias("length"), "score",
        (F.col("score") >= 0.5).alias("secret"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"), delete=spelling.DELETE)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroids.cluster(vectors).drop("embedding")


def op13_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{Scratch(spark, 'token-files').root}/files"
    repair.write(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return repair.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op13_repair_token_files": op13_repair_token_files,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op11_spelling_variants": op11_spelling_variants,
    "op5_secret_scan": op5_secret_scan,
    "op4_nn_descent": op4_nn_descent,
    "op10_line_runs": op10_line_runs,
    "op7_suffix_groups": op7_suffix_groups,
    "op9_jaccard_join": op9_jaccard_join,
    "op2_context_tree_scoring": op2_context_tree_scoring,
    "op3_counterfactual_toxicity": op3_counterfactual_toxicity,
    "op1_pivotal_mixing": op1_pivotal_mixing,
    "op6_byte_bpe": op6_byte_bpe,
    "op8_line_quality_rules": op8_line_quality_rules,
}
