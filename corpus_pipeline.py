"""Stages that clean `documents` and pack them into training sequences.

Each stage gets the table its predecessor wrote, calls one operator of aerolake.llm, and
(but for the last) returns the columns it got. Nulls, empty tables, repeated rows and
further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import common, decontam, langid, packing, pii, simhash

#: A document goes if its language is ``und`` or less sure than this (the least possible
#: score of four languages is 0.25): short but clean texts stay.
MIN_LANGUAGE_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay."""
    return langid.keep_known(docs, MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least doc_id."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of `benchmark` stay."""
    return decontam.remove(docs, decontam.benchmark(spark, sf_dir))


def remove_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; spans of personal data become [EMAIL], [IP], [CARD], [PHONE], and
    n_chars follows the text where it changed."""
    before = docs.withColumn("_text", F.col("text"))
    out = pii.redact(before)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text") == F.col("_text"), F.col("n_chars")).otherwise(
            F.coalesce(F.length("text").cast(kind), F.col("n_chars"))))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in sequences of 2048."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", remove_pii),
    ("best_fit_packing", pack),
]

#: Learned models and tokenizers have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each result is written and read again."""
    docs = common.documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.staged(docs, f"pipeline_{name}")
    return docs
