"""The corpus pipeline: each stage reads what the one before kept, and writes Parquet that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnflow.llm import bpe, decontamination, quality, secret_scan, simhash
from churnflow.llm.common import read_table
from churnflow.llm.queries import tokenizer_path
from churnflow.session import work_folder, work_scope


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on this table's labels, doesn't reject."""
    return quality.of_good_quality(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    return decontamination.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secret_scan.without_secrets(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids``, and digests of the ids and of the text decoded from them."""
    return bpe.encode_decode(docs, tokenizer_path()).select("doc_id", "ids", *bpe.digests())


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_encoding),
]

#: A trained classifier and a tokenizer can't be stated in SQL; tests check the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written and read again, and returns the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, name.replace(" ", "-"))
        # What a stage keeps for itself goes with it.
        with work_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
