"""Reading and writing texts, images, JSON records and CSV."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold import schemas


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder every executor sees, under ``spark.checkpoint.dir``.

    Only a local session may do without that setting.
    """
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = os.path.join(tempfile.gettempdir(), "inkfold")
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def remove_work_folders(spark: SparkSession) -> None:
    """Delete what this application stored on the way, once its results are written elsewhere."""
    _remove(spark, _own_folder(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# File names ---------------------------------------------------------------


def file_filter(files: DataFrame, ending: str = ".jpg", name: str = "name") -> DataFrame:
    """Keep names with the ending, skip hidden files."""
    return files.where(F.endswith(name, F.lit(ending)) & ~F.startswith(name, F.lit(".")))


def file_key(name: Column) -> Column:
    """First number in a file name: ``img_12.jpg``, ``0012_x.jpg`` and ``12.txt`` give 12."""
    return F.regexp_extract(name, "([0-9]+)", 1).try_cast("bigint")


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, "\\.[^.]*$", "")


# Sources ------------------------------------------------------------------


def text_scan(spark: SparkSession, folder: str, pattern: str = "*.txt", key_folder: str | None = None) -> DataFrame:
    """One row per text file: ``name``, ``doc_id`` and the whole ``text`` (line ends as \\n).

    The key is the number in the file name, or with ``key_folder`` the number
    in the folder ``<key_folder>=<n>`` or the file ``<key_folder>=<n>.txt`` as written by ``text_sink``. Spark does
    not list files without content; ``truth_join(..., missing_as_empty=True)``
    scores those as empty results.
    """
    files = (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
             .text(folder, wholetext=True))
    text = F.regexp_replace("value", "\r\n?", "\n")
    key = file_key(F.col("_metadata.file_name"))
    if key_folder:
        key = F.regexp_extract(F.col("_metadata.file_path"), f"/{key_folder}=(-?[0-9]+)[/.]", 1).try_cast("bigint")
    return files.select(F.col("_metadata.file_name").alias("name"), key.alias("doc_id"), text.alias("text"))


def image_scan(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per readable image file: ``name``, ``img_id``, ``image``; broken files are dropped."""
    files = (spark.read.format("image").option("dropInvalid", True).option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True).load(folder))
    name = F.regexp_extract(F.col("image.origin"), "([^/]+)$", 1)
    return files.select(name.alias("name"), file_key(name).alias("img_id"), "image")


def json_source(spark: SparkSession, folder: str, schema: T.StructType = schemas.KEYED_RECORD) -> DataFrame:
    """Records with a known schema; no inference pass."""
    return spark.read.schema(schema).option("allowSingleQuotes", False).json(folder)


# Sinks: each clears and rewrites its folder -------------------------------


def json_sink(records: DataFrame, folder: str) -> None:
    """One JSON object per record, nulls kept, text not escaped."""
    records.write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def csv_sink(table: DataFrame, folder: str) -> None:
    """CSV with header and no index; quotes doubled, so any text reads back."""
    table.write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def csv_source(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(folder))


# Texts, each a file, that one task writes.
FILES_PER_TASK = 5_000


def text_sink(texts: DataFrame, folder: str, one_file_per_key: bool = False) -> None:
    """Texts keyed by ``doc_id``; or one file per key, ``doc_id=<n>.txt``, each text closed by a line end.

    Files of single keys are written by the tasks side by side, without a folder per key
    and without a step of the driver per file. The texts of a key that comes again stand in its file.
    """
    if not one_file_per_key:
        texts.select("doc_id", "text").write.mode("overwrite").parquet(folder)
        return
    from inkfold.sources import blobs

    spark = texts.sparkSession
    _remove(spark, folder)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-texts.count() // FILES_PER_TASK))
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    content = F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary")
    rows = texts.select(F.concat(F.lit("doc_id="), number, F.lit(".txt")).alias("name"), content.alias("content"))
    blobs.blob_sink(rows.repartition(parts, "name").sortWithinPartitions("name"), folder)


def image_sink(images: DataFrame, folder: str) -> None:
    images.write.mode("overwrite").parquet(folder)


def overwrite_output(table: DataFrame, folder: str, partition: str | None = None) -> None:
    """Replace a folder, or only the partitions the table holds."""
    writer = table.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    writer.parquet(folder)
