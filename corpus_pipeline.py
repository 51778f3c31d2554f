"""A corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkfold.llm import stages
from inkfold.llm.common import stored

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("mix_sources", stages.mix_sources),
    ("encode", stages.encode),
]

# Fingerprints, seating and shortest paths have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
