"""A training-data pipeline over documents: language, quality, near duplicates, mixture, sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doctables.llm import jaccard, langid, mixing, packing, quality, shared


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts without letters, or without a language that stands out, go."""
    return langid.known_language(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.kept_by_rules(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return jaccard.keep_one(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return mixing.mixed(docs).filter("kept").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, with sequence and offset."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]
#: The classifier, the sample of documents and the packing are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
