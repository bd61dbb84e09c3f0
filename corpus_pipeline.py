"""Five stages from raw documents to token digests, each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rainroute.llm import stages
from rainroute.session import scratch_path

STAGES = stages.STAGES

#: The toxicity stage is a trained model, which SQL does not express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
