"""A result table that grows run by run, each run counted exactly once.

The rows of a run go to a folder of their own attempt. Only when they are all
written does one row of the log name the attempt; it is one small file, which Spark's
writer moves into place whole. So a run that was cut off leaves nothing a reader
sees, and a run that is repeated takes the place of its earlier attempt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "run string, attempt string, rows bigint, at timestamp"


def _write_attempt(results: DataFrame, folder: str) -> str:
    attempt = uuid.uuid4().hex
    results.write.parquet(f"{folder}/data/attempt-{attempt}")
    return attempt


def append_run(results: DataFrame, folder: str, run: str) -> None:
    """Add the rows of a run, or replace those of the same run. An empty run is a run without rows."""
    spark = results.sparkSession
    attempt = _write_attempt(results, folder)
    rows = spark.read.schema(results.schema).parquet(f"{folder}/data/attempt-{attempt}").count()
    line = spark.range(1).select(F.lit(run).alias("run"), F.lit(attempt).alias("attempt"), F.lit(rows).cast("bigint").alias("rows"),
                                 F.current_timestamp().alias("at"))
    line.coalesce(1).write.mode("append").parquet(f"{folder}/log")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """``run, attempt, rows, at`` of the attempt that counts of every run: the last that was finished."""
    log = spark.read.schema(LOG).parquet(f"{folder}/log")
    return log.groupBy("run").agg(F.max(F.struct("at", "attempt", "rows")).alias("m")).select("run", "m.attempt", "m.rows", "m.at")


def read_runs(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all runs and their ``run``; only folders of counting attempts are read.

    The log has one row per run, so the list of folders is as long as there are runs.
    """
    held = runs(spark, folder).collect()
    if not held:
        wanted = spark.createDataFrame([], schema)
        return wanted.withColumn("run", F.lit(None).cast("string"))
    found = spark.read.schema(schema).parquet(*[f"{folder}/data/attempt-{r['attempt']}" for r in held])
    attempt = F.regexp_extract(F.col("_metadata.file_path"), "/attempt-([0-9a-f]+)/", 1)
    names = spark.createDataFrame([(r["attempt"], r["run"]) for r in held], "_attempt string, run string")
    return found.withColumn("_attempt", attempt).join(names, "_attempt").drop("_attempt")
