"""One file per row: a Python data source that writes named contents, and gray images as files."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyarrow import fs as filesystems
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from inkfold.sources.files import file_key

FORMAT = "one_file_per_row"
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class BlobWriter(DataSourceArrowWriter):
    """Writes ``content`` to ``<folder>/<name>``.

    A file appears whole or not at all: it is written beside its place and moved
    there. Contents of one name that follow each other make one file. A task that runs twice writes the same files again. A write that fails takes
    back what its finished tasks wrote; a task that was stopped may leave whole files,
    which the next try writes again.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = filesystems.FileSystem.from_uri(self.folder)
        system.create_dir(root, recursive=True)
        names = []
        rows = ((name.as_py(), content) for batch in iterator for name, content in zip(batch.column("name"), batch.column("content")))
        for name, same in groupby(rows, key=itemgetter(0)):
            # Spark's sources skip files that begin with a dot or underscore.
            beside = f"{root}/_{uuid.uuid4().hex}"
            with system.open_output_stream(beside) as out:
                for _, content in same:
                    out.write(content.as_py())
            system.move(beside, f"{root}/{name}")
            names.append(name)
        return Written(names)

    def abort(self, messages: list[Written | None]) -> None:
        """What finished tasks wrote is taken back."""
        system, root = filesystems.FileSystem.from_uri(self.folder)
        for message in filter(None, messages):
            for name in message.names:
                system.delete_file(f"{root}/{name}")


class BlobSource(DataSource):
    """``df.write.format("one_file_per_row").mode("append").save(folder)`` for ``name, content``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> BlobWriter:
        if overwrite:
            raise ValueError("files are added, or replaced by name; clear the folder first to overwrite")
        return BlobWriter(self.options["path"])


def blob_sink(rows: DataFrame, folder: str) -> None:
    """One file per row of ``name, content``; other columns are left out. Names must not be null, and equal ones must follow each other."""
    rows.sparkSession.dataSource.register(BlobSource)
    rows.select("name", "content").write.format(FORMAT).mode("append").save(folder)


def png_file(height: int, width: int, data: bytes) -> bytes:
    """An uncompressed gray image of 8 bits as a PNG file."""
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    # Each line begins with its filter, here none.
    lines = b"".join(b"\x00" + data[y * width:(y + 1) * width] for y in range(height))
    return (PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(lines, 0)) + chunk(b"IEND", b""))


@F.pandas_udf(T.BinaryType())
def _png(height: pd.Series, width: pd.Series, data: pd.Series) -> pd.Series:
    return pd.Series([png_file(h, w, d) for h, w, d in zip(height, width, data)], dtype=object)


def png_content(height: Column, width: Column, data: Column) -> Column:
    return _png(height, width, data)


def image_file_sink(images: DataFrame, folder: str) -> None:
    """Gray image rows (``img_id, height, width, data``) as files ``img_<id>.png``."""
    name = F.concat(F.lit("img_"), F.col("img_id").cast("string"), F.lit(".png"))
    blob_sink(images.select(name.alias("name"), png_content(F.col("height"), F.col("width"), F.col("data")).alias("content")), folder)


def image_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per image file: ``name, img_id, broken, image``; a file that cannot be read is kept as broken, without image.

    ``image`` has ``height, width, nChannels, mode, data`` as Spark's image source gives them.
    """
    files = (spark.read.format("image").option("dropInvalid", False).option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True).load(folder))
    name = F.regexp_extract(F.col("image.origin"), "([^/]+)$", 1)
    broken = F.col("image.height") < 0
    parts = F.struct(*[F.col(f"image.{c}") for c in ("height", "width", "nChannels", "mode", "data")])
    return files.select(name.alias("name"), file_key(name).alias("img_id"), broken.alias("broken"), F.when(~broken, parts).alias("image"))


def broken_files(found: DataFrame) -> DataFrame:
    """``n_files, n_broken`` of what ``image_files`` found."""
    return found.agg(F.count("*").alias("n_files"), F.count_if("broken").alias("n_broken"))
