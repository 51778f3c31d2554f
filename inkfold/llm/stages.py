"""Stages of the corpus pipeline, each a call of one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm import line_dedup as lines
from inkfold.llm import mixing, quality, sentencepiece, simhash
from inkfold.llm.queries import PIECES, tokenizer_path

# Words of a shingle in the near-duplicate stage, as in op2_simhash.
SHINGLE = 3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows the rules keep, unchanged; null and empty texts fail, an empty table gives an empty result."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; rows without words are never taken more often than their source's whole copies."""
    return mixing.mixed_rows(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; ``n_chars`` follows the text."""
    left = lines.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints of three-word shingles are linked by at most three bits, the one with the smallest id.

    Null and empty texts are one group; rows of one text are too. An empty table gives an empty result.
    """
    return simhash.one_per_group(docs, words=SHINGLE, radius=simhash.RADIUS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, ids, n_tokens``; a null text has null ids, an empty one none; repeated rows are encoded each."""
    model = sentencepiece.model_bytes(tokenizer_path(PIECES))
    rows = sentencepiece.encode(docs, model)
    return rows.select("doc_id", "source", "ids", F.size("ids").alias("n_tokens"))
