"""Files that arrive over time: read as a stream, worked on row by row, each exactly once.

The checkpoint holds which files were taken; the parquet sink holds a log of what each
batch wrote. So a run takes what is new since the last, and a run that was cut off is
finished by the next without a row twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.sources.files import file_key

# Files taken per batch, so that a backlog does not become one batch.
FILES_PER_BATCH = 1000


def text_stream(spark: SparkSession, folder: str, pattern: str = "*.txt", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Text files as they arrive: ``name, doc_id, text`` as in ``text_scan``."""
    files = (spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", files_per_batch).text(folder, wholetext=True))
    name = F.col("_metadata.file_name")
    return files.select(name.alias("name"), file_key(name).alias("doc_id"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def record_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Files of JSON records as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def run_available(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Work through all files there are and stop; the result is added to ``out`` as parquet."""
    query = (work(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
