"""The registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html_extraction, language_id, license_scan, lm_scoring, minhash_dedup, mixing, prefix_forest, substring_dedup, suffix_dedup
from .tables import read


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), length=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return prefix_forest.nearest(vectors, F.col("id") % 20 == 0, k=20).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.fold("doc_id", 4) == 2
    documents = read(spark, sf_dir, "documents").withColumn("held_out", held_out)
    return language_id.identify(documents, F.col("held_out"), keep=["doc_id", "held_out"])


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.strip_repeats(read(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.drop("detections")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read(spark, sf_dir, "documents"), language_id.fold("doc_id", 5) == 1)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.strip_repeats(read(spark, sf_dir, "documents"), length=35).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (f for name, f in globals().items() if name.startswith("op") and callable(f))
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}
