"""The corpus pipeline: toxicity filter, line de-duplication, near-duplicate
removal, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordon.llm import decontamination, line_dedup, ngram_jaccard, packing, toxicity
from cordon.llm.common import table, written


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line passages and passages of over 50 words go; every row stays, n_chars follows the text."""
    out = line_dedup.dedup_lines(docs, passages=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the smallest doc_id."""
    return ngram_jaccard.one_per_class(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as packed pieces."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("packing", stage_packing),
]
#: The toxicity stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
