"""From raw documents to packed training sequences: classify, apply rules, drop near-duplicates, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import minhash, packing, quality, rules
from daybook.llm.common import settle, table, tokenizer_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.keep_passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: similarity of 0.8 or more on shingles of five words."""
    return minhash.one_of_each(docs, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in token sequences."""
    return packing.packed_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality_classifier", classify), ("quality_rules", apply_rules), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: A trained classifier and a packing search have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = settle(docs)
    return docs
