"""From raw documents to packed token sequences: five stages over the operators of ``acreage.llm``.

Each stage takes the rows its predecessor kept and returns rows of the same columns; the last returns packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreage.llm.decontamination import decontaminated
from acreage.llm.jaccard_join import deduplicated
from acreage.llm.mixing import mixed_rows
from acreage.llm.packing import packed_sequences
from acreage.llm.resampling import resampled_rows
from acreage.llm.shared import cut_lineage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return resampled_rows(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal ones."""
    return deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of benchmark passages."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_rows(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of token ids."""
    return packed_sequences(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_packing", token_packing),
]

#: The stages are not expressible in SQL; the tests hold them against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
