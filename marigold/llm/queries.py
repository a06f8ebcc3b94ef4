"""One query for each operator on single documents and vectors, with production parameters over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marigold.llm import embedding_dedup, line_dedup, minhash, mixing, packing, quality_model, quality_rules, substring_dedup, token_counts, token_files
from marigold.staging import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.group(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allocate(table(spark, sf_dir, "documents"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept_text")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.clean(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents")).drop("clean_text")


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_token_files": op4_token_files,
    "op5_token_counts": op5_token_counts,
    "op6_mix_sources": op6_mix_sources,
    "op7_pack": op7_pack,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
}
