"""Repeated runs of lines, found by distributed prefix doubling, and their removal.

The suffixes of all documents, as sequences of line ids, are refined by rounds:
round k gives every position the name of the 2^k lines that begin there, made
from two names of the round before, one of them 2^k / 2 lines on. Positions of
one name are the intervals of the suffix array whose common prefix has at least
2^k lines; names take the place of ranks, as only equality within an interval is
asked for, so no global sort is needed. A position that is alone in its interval
drops out, so each round works on what still repeats.

A run of lines is a copy if it has enough words and occurs earlier. Every such
run is the union of its shortest stretches with enough words, one from each line
forward and one from each line back. A stretch of n lines has the name of two
blocks of the greatest power of two, one at its start and one at its end, so its
interval - common prefix n - follows from one round's names. All stretches of an
interval but the first are later copies, and maximal runs come out as the union
of stretches that overlap. Rounds end at the longest stretch asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold.functions.text import let
from inkfold.llm.common import free_names, stored

# Words from which on a repeated run counts as copied.
MIN_WORDS = 10


def _stretches(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest stretch with enough words from each line forward, and back; 0 where none has."""
    n, upto = len(words), np.cumsum(words)
    before = upto - words
    end = np.searchsorted(upto, before + least)
    start = np.searchsorted(before, upto - least, side="right") - 1
    place = np.arange(n)
    return np.where(end < n, end - place + 1, 0), np.where(upto >= least, place - start + 1, 0)


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``row, doc_id, pos, a, b, ahead, back``: one row per line, named by 128 bits of hash.

    ``ahead`` and ``back`` are the lines of the shortest stretches that begin and
    end there and have ``min_words`` words (0: none has).
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    longs = [T.StructField(c, T.LongType()) for c in ("pos", "a", "b", "ahead", "back")]
    schema = T.StructType([rows.schema["row"], rows.schema["doc_id"], *longs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for part in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            numbers, of = [], []
            for i, text in enumerate(part.column("text")):
                lines = text.as_py().split(b"\n")
                words = np.array([len(x.split()) for x in lines])
                names = [np.array([xxh64_intdigest(x, seed) for x in lines], dtype="u8").view("i8") for seed in (0, 1)]
                numbers.append([np.arange(len(lines)), *names, *_stretches(words, min_words)])
                of.append(np.full(len(lines), i))
            columns = [pa.array(np.concatenate(c).astype("i8")) for c in zip(*numbers)]
            given = part.select(["row", "doc_id"]).take(pa.array(np.concatenate(of)))
            yield pa.RecordBatch.from_arrays([*given.columns, *columns], names=schema.names)
    return rows.mapInArrow(run, schema)


def _place() -> Column:
    """Order of copies: by document id (null last), row and line."""
    return F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row").alias("row"), F.col("pos").alias("pos"))


def _repeated(named: DataFrame) -> DataFrame:
    """Rows whose name occurs again, and whether an earlier one has it (``later``).

    A name that very many positions bear is combined before the shuffle, and its
    positions join one row. Intervals are stored first: with a plain exchange on
    both sides Spark deals a hot name's positions to several tasks.
    """
    intervals = named.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1")
    intervals = stored(intervals.drop("n"), "line-intervals")
    later = (F.col("first") < _place()).alias("later")
    return named.join(intervals, ["a", "b"]).select(*named.columns, later)


def repeated_runs(lines: DataFrame) -> DataFrame:
    """``row, start, stop``: the stretches of lines to delete, apart from each other.

    A line is deleted if it lies in a run of consecutive lines that has enough
    words (what ``line_table`` was asked for) and occurs earlier.
    """
    level = stored(_repeated(lines).drop("later"), "line-level")
    # A stretch whose own first or last line is not repeated cannot be.
    asked = level.select("row", "doc_id", F.inline(F.array(
        F.struct(F.col("pos"), F.col("ahead").alias("n")), F.struct((F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("n")))))
    asked = stored(asked.where("n > 0").distinct(), "line-stretches")
    longest = asked.agg(F.max("n")).first()[0] or 0
    level, size, named = level.select("row", "doc_id", "pos", "a", "b"), 1, []
    while size <= longest:
        # Stretches of size to 2 size - 1 lines: the block at their start and the one at their end.
        first = level.select("row", "pos", F.col("a").alias("a1"), F.col("b").alias("b1"))
        last = level.select("row", F.col("pos").alias("tail"), F.col("a").alias("a2"), F.col("b").alias("b2"))
        own = asked.where((F.col("n") >= size) & (F.col("n") < 2 * size)).withColumn("tail", F.col("pos") + F.col("n") - size)
        named.append(own.join(first, ["row", "pos"]).join(last, ["row", "tail"]).select(
            "row", "doc_id", "pos", "n", F.xxhash64("n", "a1", "a2").alias("a"), F.xxhash64("n", "b1", "b2").alias("b")))
        if 2 * size <= longest:
            ahead = level.select("row", (F.col("pos") - size).alias("pos"), F.col("a").alias("a2"), F.col("b").alias("b2"))
            longer = level.join(ahead, ["row", "pos"]).select(
                "row", "doc_id", "pos", F.xxhash64("a", "a2").alias("a"), F.xxhash64("b", "b2").alias("b"))
            level = stored(_repeated(longer).drop("later"), "line-level")
            if level.isEmpty():
                break
        size *= 2
    if not named:
        return asked.select("row", F.col("pos").alias("start"), F.col("pos").alias("stop")).limit(0)
    copies = _repeated(stored(reduce(DataFrame.unionByName, named), "line-named")).where("later")
    blocks = copies.select("row", F.col("pos").alias("start"), (F.col("pos") + F.col("n")).alias("stop"))
    # Copies that touch or overlap are one stretch.
    by_start = Window.partitionBy("row").orderBy("start", "stop")
    before = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = blocks.withColumn("fresh", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    numbered = fresh.withColumn("stretch", F.sum("fresh").over(by_start))
    return numbered.groupBy("row", "stretch").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("stretch")


def _without(text: Column, gone: Column) -> Column:
    """Lines outside the stretches of ``gone`` (sorted, apart), in time linear in the text."""
    def rest(lines: Column) -> Column:
        begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(gone, lambda g: g["stop"]))
        ends = F.concat(F.transform(gone, lambda g: g["start"]), F.array(F.size(lines).cast("bigint")))
        kept = F.transform(F.arrays_zip(begins.alias("x"), ends.alias("y")), lambda z: F.slice(lines, (z["x"] + 1).cast("int"), (z["y"] - z["x"]).cast("int")))
        return F.array_join(F.flatten(kept), "\n")
    return let(F.split(text, "\n"), rest)


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with the text that is left, and ``n_lines, n_removed`` (bigint).

    Copies are in order of ``doc_id`` (null last) and then of place, so of
    repeated rows the first keeps its lines. Lines are what "\\n" parts; they are
    compared as they are, and only lines in runs that have ``min_words`` words
    together and occur earlier go. A document may lose all its lines and keeps its row with
    an empty text; a null text stays null and has no lines; an empty table gives
    an empty result. Columns called like the added ones are replaced. ``docs``
    must be a stored table: rows are told apart by their place.
    """
    place, cut = free_names(docs, "place", "cut")
    gone = repeated_runs(line_table(docs, doc_id, text, min_words))
    gone = gone.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(cut))
    removed = F.aggregate(cut, F.lit(0).cast("bigint"), lambda total, g: total + g["stop"] - g["start"])
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*names, F.monotonically_increasing_id().alias(place)).join(gone.withColumnRenamed("row", place), place, "left")
    left = F.when(F.col(cut).isNull(), F.col(text)).otherwise(_without(F.col(text), F.col(cut)))
    n_lines = F.coalesce(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"))) + 1, F.lit(0))
    return rows.select(*[left.alias(c) if c == text else F.col(c) for c in names], n_lines.cast("bigint").alias("n_lines"),
                       F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"))
