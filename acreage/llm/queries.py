"""Registered queries of this package, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acreage.llm import (
    collocations, decontamination, disclosure, html_text, jaccard_join, line_rules, mixing, packing, resampling, secret_scan, toxicity, url_models, variants,
)
from acreage.llm import oracles as oracles_sql
from acreage.llm.shared import table


def op1_token_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(table(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages"))


def op3_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_disclosure_sanitising(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.disclosure_digest(disclosure.disclosing(table(spark, folder, "documents")))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontamination.benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.contamination_digest(hits)


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies"
    )


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.secret_spans(table(spark, folder, "documents")))


def op10_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.line_quality(table(spark, folder, "documents"))


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(table(spark, folder, "documents"))


def op13_url_models(spark: SparkSession, folder: str) -> DataFrame:
    return url_models.judged_urls(table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_packing": op1_token_packing,
    "op2_html_extraction": op2_html_extraction,
    "op3_importance_resampling": op3_importance_resampling,
    "op4_disclosure_sanitising": op4_disclosure_sanitising,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_source_mixing": op6_source_mixing,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_secret_scan": op9_secret_scan,
    "op10_line_rules": op10_line_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_url_models": op13_url_models,
}

ORACLES: dict[str, str] = {
    "op5_benchmark_decontamination": oracles_sql.OP5,
    "op7_ngram_jaccard_join": oracles_sql.OP7,
    "op10_line_rules": oracles_sql.OP10,
    "op11_phrase_collocations": oracles_sql.OP11,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
