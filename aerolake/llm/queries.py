"""One query for each operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clustering, counting, decontam, divergence, langid, licences, lm, neighbours, packing, pii, quality, simhash, tokenfile
from .common import documents


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) where the document holds 0.8 or more of the item's shingles."""
    return decontam.find(documents(spark, sf_dir), decontam.benchmark(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).drop("rejected_by")


def op4_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(documents(spark, sf_dir))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_tokens(documents(spark, sf_dir))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice found: doc_id, paragraph, family, probability, template, similarity."""
    return licences.scan(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(embeddings(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(embeddings(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing,
    op2_benchmark_decontamination,
    op3_quality_rules,
    op4_token_id_output,
    op5_lm_scoring,
    op6_pii,
    op7_simhash_near_dedup,
    op8_token_counts,
    op9_license_scans,
    op10_language_id,
    op11_nearest_neighbours,
    op12_source_divergence,
    op13_centroid_clustering,
)}

ORACLE_SQL: dict[str, str] = {
    "op2_benchmark_decontamination": decontam.SQL,
    "op3_quality_rules": quality.SQL,
    "op12_source_divergence": divergence.SQL,
    "op13_centroid_clustering": clustering.SQL,
}
