"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import ann, audit, codes, htmltext, licences, minhash, packing, pieces, quality, rules, sharding, tokenfile, toxicity
from daybook.llm.common import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), digest=True)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.document_licences(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.measured(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"))


def op10_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.report(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {"op1_minhash": op1_minhash, "op2_pieces": op2_pieces, "op3_packing": op3_packing, "op4_ann": op4_ann, "op5_quality": op5_quality, "op6_licences": op6_licences, "op7_toxicity": op7_toxicity, "op8_rules": op8_rules,
                             "op9_sharding": op9_sharding, "op10_htmltext": op10_htmltext,
                             "op11_audit": op11_audit, "op12_tokenfile": op12_tokenfile, "op13_codes": op13_codes}
ORACLE: dict[str, str] = {"op6_licences": licences.ORACLE_SQL, "op8_rules": rules.ORACLE_SQL, "op11_audit": audit.ORACLE_SQL, "op13_codes": codes.ORACLE_SQL}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {**QUERIES, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
