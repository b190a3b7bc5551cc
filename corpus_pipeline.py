"""From documents to packed training sequences, in stages that are each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formflow.llm import decontamination, minhash, packing, quality, secrets
from formflow.llm.queries import table, tokenizer_path
from formflow.session import intermediates, materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a rule with a calibrated cutoff rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret's characters masked."""
    return secrets.masked(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("best-fit packing", best_fit_packing),
]

#: Tokenising, calibration and components have no SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1], 1):
        with intermediates(spark):  # a stage's own tables go once its result is written
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{number}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
