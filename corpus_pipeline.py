"""The corpus pipeline: documents through five operators, each stage stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import stages
from tripweave.session import scratch_path

STAGES = [
    ("language_id", stages.language_id),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("secret_scan", stages.secret_scan),
    ("packing", stages.pack),
]

# Hashes, tokenizers and trained models are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that every stage keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
