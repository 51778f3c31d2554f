"""Token counts through a digest cache.

A count is stored under two digests: one of the normalised content, one of the
tokenizer (file, library and its version). Texts are joined to the stored counts
by digest; of the misses each distinct content is encoded once, its count is
appended to the cache, and every document reads its count from there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.llm.common import GAP, WHITE, stored
from inkfold.sources.files import work_folder

# Words whose counts a task remembers; beyond, memory starts anew.
REMEMBERED = 1 << 18
# A file of counts is read by part of the version's folder.
SCHEMA = "digest binary, n_tokens bigint, version string"


def _split(text: str) -> list[str]:
    """Words between white space.

    Unlike str.split(), Unicode does not take the four separators for white space.
    """
    if not _SEPARATORS(text):
        return text.split()
    return [w for w in _WHITE(text) if w]


_SEPARATORS = re.compile("[\x1c-\x1f]").search
_WHITE = re.compile(r"[^\S\x1c-\x1f]+").split


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file (.json: tokenizers, .model: sentencepiece).

    ``white_separates`` says that white space only separates: the tokenizer drops
    it and no token reaches over it. Then runs of ASCII white space are
    normalised to one space, and a text's count is the sum over its words.
    """

    data: bytes
    kind: str
    white_separates: bool = False

    @staticmethod
    def read(path: str, white_separates: bool = False) -> Tokenizer:
        with open(path, "rb") as f:
            return Tokenizer(f.read(), path.rpartition(".")[2], white_separates)

    def version(self) -> str:
        if self.kind == "json":
            import tokenizers as library
        else:
            import sentencepiece as library
        facts = f"{self.kind} {library.__version__} {self.white_separates} "
        return hashlib.sha256(facts.encode() + self.data).hexdigest()

    def normalized(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        return F.btrim(F.regexp_replace(text, GAP, " "), F.lit(WHITE)) if self.white_separates else text

    def counter(self) -> Callable[[list[str]], list[int]]:
        """Counts of texts: no begin, end or added tokens, no truncation, no padding."""
        if self.kind == "json":
            import os

            from tokenizers import Tokenizer as Json

            # A task has one core.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            machine = Json.from_str(self.data.decode())
            machine.no_truncation()
            machine.no_padding()
            return lambda texts: [len(e.ids) for e in machine.encode_batch(texts, add_special_tokens=False)]
        from sentencepiece import SentencePieceProcessor

        machine = SentencePieceProcessor(model_proto=self.data)
        return lambda texts: [len(ids) for ids in machine.encode(texts, num_threads=1)]

    def text_counter(self) -> Callable[[str], int]:
        """Count of a text; words seen before are not encoded again.

        When memory is full, what was seen becomes the older half; words still in
        use come back from there.
        """
        count = self.counter()
        if not self.white_separates:
            return lambda text: count([text])[0]
        known: dict[str, int] = {}
        older: dict[str, int] = {}

        def of_text(text: str) -> int:
            nonlocal known, older
            words = _split(text)
            new = set(words).difference(known)
            if new and len(known) + len(new) > REMEMBERED:
                known, older, new = {}, known, set(words)
            known.update((w, older[w]) for w in new if w in older)
            new = [w for w in new if w not in older]
            for at in range(0, len(new), 1 << 14):
                part = new[at:at + (1 << 14)]
                known.update(zip(part, count(part)))
            return sum(map(known.__getitem__, words))
        return of_text


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of a version; a content stored twice counts once."""
    rows = spark.read.schema(SCHEMA).option("basePath", cache).parquet(cache).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: Tokenizer, cache: str | None = None, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens``, one row per input row, and the cache brought up to date.

    Null texts count as empty: no bytes, no tokens. Repeated rows and copies are
    encoded once. Columns beside the two named are not looked at. An empty table
    gives an empty result. ``docs`` must be a stored table: the row that stands
    for a content is found by its place. Without ``cache`` a new one is begun in
    the shared folder. A run that is cut short leaves no half-written counts.
    """
    spark = docs.sparkSession
    cache, version = cache or work_folder(spark, "token-cache"), tokenizer.version()
    # Makes the folder of a new cache; adds nothing to an old one.
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(cache)
    content = tokenizer.normalized(F.col(text))
    place = F.monotonically_increasing_id()
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    raw = F.coalesce(F.col(text), F.lit(""))
    keyed = stored(docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(raw).cast("bigint").alias("n_bytes"),
                               digest.alias("digest"), place.alias("place")), "token-digests")
    known = stored_counts(spark, cache, version)
    misses = keyed.groupBy("digest").agg(F.min("place").alias("place")).join(known, "digest", "left_anti")
    texts = docs.select(place.alias("place"), raw.alias("content"))
    # Places are unique, so a content that very many documents share is one row here.
    missed = misses.join(texts, "place").select("digest", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.text_counter()
        for batch in batches:
            found = pa.array([count(t.as_py()) for t in batch.column("content")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), found], names=["digest", "n_tokens"])
    counted = missed.mapInArrow(run, "digest binary, n_tokens bigint").withColumn("version", F.lit(version))
    counted.write.mode("append").partitionBy("version").parquet(cache)
    # Stored, so that both sides are plain exchanges: Spark then deals a digest that very many documents share to several tasks.
    counts = stored(stored_counts(spark, cache, version), "token-counts")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
