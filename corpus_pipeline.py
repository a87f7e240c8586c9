"""The corpus pipeline: stages over documents, each written as Parquet and read again for the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripstrata.llm.queries import bpe_stage, line_stage, mix_stage, near_dup_stage, quality_stage
from tripstrata.llm.shared import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dups", near_dup_stage),
    ("mixing", mix_stage),
    ("bpe", bpe_stage),
]

#: Trained thresholds, edit distances and a byte-pair vocabulary are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}")
    return docs
