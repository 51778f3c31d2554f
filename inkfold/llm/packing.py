"""Token ids packed into rows of equal length, by best-fit decreasing.

Documents are encoded, closed with an end token and cut into full rows and a
rest. The rests are packed: longest first, each into the row with the least room
that still holds it. What best-fit decreasing does depends on the lengths alone,
so it runs on their histogram, which has at most one entry per length whatever
the data's size: rows with the same room form a class, a segment tree over the
room finds the class to fill, and as many rests as fit go into it at once. The
plan says which ranks of a length go to which rows; ranks are counted per
length and input partition, so no length is gathered in one task.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.common import stored

# Lines of a packing plan that may be broadcast (some 50 bytes each).
PLAN_LINES = 100_000


def byte_encoder(ranks: bytes, pattern: str):
    """Function from a text to the ids of a byte-level BPE, from a rank file; special strings are ordinary text."""
    import base64

    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary


class Numbering:
    """What ``pack`` must know of the rows that one task reads, in their order."""

    def __init__(self, size: int) -> None:
        from pyspark import TaskContext

        self.size, self.part, self.whole = size, TaskContext.get().partitionId(), 0
        self.seen = np.zeros(size, dtype="i8")

    def columns(self, n: np.ndarray) -> list[pa.Array]:
        """The task (``part``), the full rows before each row there (``before``), its rank among rests of its length (``own``)."""
        wholes, own = n // self.size, []
        for rest in n % self.size:
            own.append(self.seen[rest])
            self.seen[rest] += 1
        before = self.whole + np.cumsum(wholes) - wholes
        self.whole += int(wholes.sum())
        return [pa.array(np.full(len(n), self.part, dtype="i8")), pa.array(before), pa.array(np.array(own, dtype="i8"))]


_TOKENS, _NUMBERS = "doc_id bigint, n bigint, ids binary", "part bigint, before bigint, own bigint"


def token_rows(docs: DataFrame, ranks: bytes, pattern: str, end: int, width: int, doc_id: str = "doc_id",
               text: str = "text", size: int | None = None) -> DataFrame:
    """``doc_id, n, ids``: ids as little-endian numbers of ``width`` (2 or 4) bytes, closed with ``end``.

    With ``size`` the rows are numbered for ``pack`` on the way.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    code = {2: "H", 4: "I"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, numbers = byte_encoder(ranks, pattern), size and Numbering(size)
        for part in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            found = [array(code, [*encode(t.as_py()), end]) for t in part.column("text")]
            if sys.byteorder == "big":
                for ids in found:
                    ids.byteswap()
            n = np.array([len(ids) for ids in found], dtype="i8")
            columns = [part.column("doc_id"), pa.array(n), pa.array([ids.tobytes() for ids in found], pa.binary())]
            names = ["doc_id", "n", "ids"]
            if numbers:
                columns, names = columns + numbers.columns(n), [*names, "part", "before", "own"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return rows.mapInArrow(run, f"{_TOKENS}, {_NUMBERS}" if size else _TOKENS)


def numbered(tokens: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, ids`` with the numbers ``pack`` needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbering(size)
        for batch in batches:
            added = numbers.columns(batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["doc_id", "n", "ids", "part", "before", "own"])
    return tokens.select("doc_id", "n", "ids").mapInArrow(run, f"{_TOKENS}, {_NUMBERS}")


class RoomTree:
    """Segment tree over room 0..size: finds the least room of at least a length that is on offer."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.full = np.zeros(2 * self.leaves, dtype=bool)

    def set(self, room: int, offered: bool) -> None:
        at = self.leaves + room
        self.full[at] = offered
        while at > 1:
            at //= 2
            self.full[at] = self.full[2 * at] or self.full[2 * at + 1]

    def least(self, length: int) -> int | None:
        at = self.leaves + length
        if self.full[at]:
            return length
        # Up until a right neighbour offers something, then down its left edge.
        while at > 1:
            if at % 2 == 0 and self.full[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.full[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_plan(histogram: dict[int, int], size: int) -> tuple[list[tuple], int]:
    """Best-fit decreasing over ``{length: count}``; lengths are 1..size.

    Gives lines ``(length, rank, count, per_row, row, offset)``: the ``count``
    rests of a length from ``rank`` on go, ``per_row`` each, to the rows from
    ``row`` on, the first at ``offset``; and the number of rows. Equal rests are
    placed at once: a row that is chosen stays the tightest until it is full.
    """
    tree, classes, plan, n_rows = RoomTree(size), {}, [], 0

    def offer(room: int, row: int, count: int) -> None:
        if room and count:
            classes.setdefault(room, []).append((row, count))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.least(length)
            if room is None:
                room, row, count = size, n_rows, -(-left // (size // length))
                n_rows += count
            else:
                row, count = classes[room].pop()
                if not classes[room]:
                    tree.set(room, False)
            per_row = room // length
            placed = min(left, per_row * count)
            plan.append((length, rank, placed, per_row, row, size - room))
            whole, more = divmod(placed, per_row)
            offer(room - per_row * length, row, whole)
            if more:
                offer(room - more * length, row + whole, 1)
            used = whole + bool(more)
            offer(room, row + used, count - used)
            rank, left = rank + placed, left - placed
    return plan, n_rows


def pack_texts(docs: DataFrame, ranks: bytes, pattern: str, end: int, size: int = 2048, width: int = 2,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed rows (see ``pack``) of texts, encoded and numbered in one step."""
    return _packed(token_rows(docs, ranks, pattern, end, width, doc_id, text, size), size, width)


def pack(tokens: DataFrame, size: int = 2048, width: int = 2) -> DataFrame:
    """Packed rows: ``row_id, n_tokens, cu_seqlens, doc_ids, starts, ids, positions``.

    ``tokens`` has ``doc_id, n, ids`` (``token_rows``). Longer documents are cut
    into full rows and a rest, nothing is lost: segment i of a row holds the
    tokens of document ``doc_ids[i]`` from ``starts[i]`` on, at
    ``cu_seqlens[i]`` to ``cu_seqlens[i + 1]``. ``ids`` and ``positions`` are
    rows of two matrices, ``size`` little-endian numbers of ``width`` and of 4
    bytes, filled up with zeros; positions begin at 0 in every segment.

    A null or empty text is a lone end token; a null doc_id is carried along;
    repeated rows are packed each; an empty table gives an empty result. Full
    rows are never shuffled; rests are, to their row. Numbers given to rows are
    stored with them, so a task that is run again finds the same.
    """
    return _packed(numbered(tokens, size), size, width)


def _packed(tokens: DataFrame, size: int, width: int) -> DataFrame:
    spark = tokens.sparkSession
    rows = stored(tokens, "packing-tokens").withColumn("rest", F.col("n") % size)
    per_part = rows.groupBy("rest", "part").agg(F.count("*").alias("c"))
    # At most one entry per length below the size of a row.
    histogram = {r["rest"]: r["c"] for r in per_part.where("rest > 0").groupBy("rest").agg(F.sum("c").alias("c")).collect()}
    plan, n_rows = best_fit_plan(histogram, size)

    per_task = rows.groupBy("part").agg(F.sum(F.floor(F.col("n") / size)).alias("w"))
    upto = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select("part", (F.coalesce(F.sum("w").over(upto), F.lit(0)) + n_rows).alias("ahead"))
    i = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("n") / size) - 1))
    full = rows.where(F.col("n") >= size).join(per_task, "part").select("doc_id", "ids", (F.col("ahead") + F.col("before")).alias("first"), i.alias("i"))
    start = F.col("i") * size
    positions = np.arange(size, dtype="<i4").tobytes()
    full = full.select(
        (F.col("first") + F.col("i")).alias("row_id"), F.lit(size).cast("bigint").alias("n_tokens"),
        F.array(F.lit(0), F.lit(size)).alias("cu_seqlens"), F.array("doc_id").alias("doc_ids"), F.array(start).alias("starts"),
        F.substring(F.col("ids"), (start * width + 1).cast("int"), F.lit(size * width)).alias("ids"), F.lit(positions).alias("positions"))

    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("rest", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("ahead"))
    lines = spark.createDataFrame(plan, "rest bigint, first bigint, c bigint, per_row bigint, row bigint, at bigint")
    lines = F.broadcast(lines) if len(plan) <= PLAN_LINES else lines
    rests = rows.where("rest > 0").select(
        "doc_id", "rest", "part", "own", (F.col("n") - F.col("rest")).alias("start"),
        F.substring(F.col("ids"), ((F.col("n") - F.col("rest")) * width + 1).cast("int"), (F.col("rest") * width).cast("int")).alias("ids"))
    rests = rests.join(offsets, ["rest", "part"]).withColumn("rank", F.col("ahead") + F.col("own")).join(lines, "rest")
    k = F.col("rank") - F.col("first")
    seated = rests.where((k >= 0) & (k < F.col("c"))).select(
        (F.col("row") + F.floor(k / F.col("per_row"))).alias("row_id"),
        F.struct((F.col("at") + (k % F.col("per_row")) * F.col("rest")).alias("at"), "doc_id", "start", "ids").alias("s"))
    # A row holds at most ``size`` tokens.
    seated = seated.groupBy("row_id").agg(F.collect_list("s").alias("segments"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row_id", "n_tokens", "cu_seqlens", "doc_ids", "starts", "ids", "positions"]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        # A few rows at a time: a row takes up to (width + 4) * size bytes.
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            out: list[list] = [[] for _ in names]
            for row_id, held in zip(batch.column("row_id").to_pylist(), batch.column("segments")):
                held = sorted(held.as_py(), key=lambda s: s["at"])
                ends = np.cumsum([0] + [len(s["ids"]) // width for s in held])
                places = np.zeros(size, dtype="<i4")
                places[:ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
                ids = b"".join(s["ids"] for s in held).ljust(size * width, b"\0")
                values = (row_id, int(ends[-1]), ends.tolist(), [s["doc_id"] for s in held], [s["start"] for s in held], ids, places.tobytes())
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
    packed = seated.mapInArrow(run, "row_id bigint, n_tokens bigint, cu_seqlens array<int>, doc_ids array<bigint>, "
                                    "starts array<bigint>, ids binary, positions binary")
    return packed.unionByName(full)


def write_packed(rows: DataFrame, folder: str) -> None:
    """Write packed rows as Parquet; the binary columns are rows of the id and position matrices."""
    rows.write.mode("overwrite").parquet(folder)
