"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint has 64 bits; two documents are linked when theirs differ in at
most three. Cut into four blocks of 16 bits, one block at least agrees. Of the
48 other bits the first 23 are read as a word of the perfect binary Golay code:
every 23-bit word lies within three bits of exactly one codeword, and the
codewords nearest to a word and to its 23 neighbours (one or six of them) are
its keys. Words that differ in at most two bits share a key, since both
neighbour a word between them. If instead all three differences fall into these
23 bits, the 25 bits left agree, which is one more key. So a fingerprint has at
most 4 * 7 keys of 28 or 41 bits, and linked fingerprints meet under one.

Fingerprints are counted per key first. Keys with one fingerprint drop out; a
key with very many is cut into blocks that meet in pairs, so no task compares
more than two blocks. What leaves a task is a forest of its links, never all
pairs; a forest has the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold.llm.common import dealt_join, free_names, stored, tasks
from inkfold.llm.components import components

RADIUS = 3
SEED = 42
# Shingles hashed at once: long texts are counted piece by piece.
PIECE = 1 << 16
# Fingerprints of one key compared in one block.
BLOCK = 1024
# Rows whose links are gathered before a forest of them is emitted.
GATHER = 1 << 16

# The generator polynomial of the Golay code and its length: fixed values.
GOLAY_POLYNOMIAL, GOLAY_BITS, GOLAY_CHECK = 0xC75, 23, 11


def fingerprint(words: list[bytes], width: int) -> int:
    """Majority bits of the XXH64 of all word shingles; fewer words are one shingle, none gives 0."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    width = min(width, len(words))
    n, ones = len(words) - width + 1, np.zeros(64, dtype="int64")
    columns = np.arange(8) * 256
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    for at in range(0, n, PIECE):
        part = words[at:at + PIECE + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width))))
        hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
        seen = np.bincount((hashes.view("u1").reshape(-1, 8) + columns).ravel(), minlength=2048)
        ones += (seen.reshape(8, 256) @ bits).ravel()
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """``doc_id, fp`` (bigint holding 64 unsigned bits). A-Z count as a-z; a null text has no words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py().lower().split(), words) for t in batch.column("text")]
            fps = pa.array(np.array(found, dtype="u8").view("i8"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], names=["doc_id", "fp"])
    return rows.mapInArrow(run, schema)


def _remainder(words: np.ndarray) -> np.ndarray:
    """Check bits of 23-bit words: the remainder by the generator polynomial."""
    left = words.copy()
    for bit in range(GOLAY_BITS - 1, GOLAY_CHECK - 1, -1):
        left ^= np.where(left >> bit & 1, GOLAY_POLYNOMIAL << (bit - GOLAY_CHECK), 0)
    return left


class Golay:
    """Index (12 bits) of the codeword nearest to a 23-bit word."""

    def __init__(self) -> None:
        one = 1 << np.arange(GOLAY_BITS, dtype="int64")
        two = (one[:, None] | one).ravel()
        errors = np.concatenate([[0], (two[:, None] | one).ravel()])
        self.error = np.zeros(1 << GOLAY_CHECK, dtype="int64")
        self.error[_remainder(errors)] = errors

    def index(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.error[_remainder(words)]) >> GOLAY_CHECK

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``words`` and the key indices of each, every pair once."""
        flips = np.append(0, 1 << np.arange(GOLAY_BITS, dtype="int64"))
        near = np.sort(self.index((words[:, None] ^ flips).ravel()).reshape(-1, len(flips)), axis=1)
        first = np.ones(near.shape, dtype=bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        return np.nonzero(first)[0], near[first]


def key_rows(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints: (fingerprint, key) pairs; a key names its block, kind and value."""
    out_fp, out_key = [], []
    for block in range(4):
        low = np.uint64(16 * block)
        agree = (fps >> low & np.uint64(0xFFFF)).astype("int64")
        below = fps & ((np.uint64(1) << low) - np.uint64(1))
        above = np.right_shift(fps >> low, np.uint64(16)) << low
        rest = (below | above).astype("int64")
        word, other = rest & 0x7FFFFF, rest >> 23
        head = (np.int64(block) << 42) | (agree << 25)
        at, index = golay.keys(word)
        out_fp += [fps[at], fps]
        out_key += [head[at] | index, np.int64(1) << 44 | head | other]
    return np.concatenate(out_fp), np.concatenate(out_key)


def fingerprint_keys(distinct: DataFrame) -> DataFrame:
    """``key, fp`` for a table of distinct ``fp``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for batch in batches:
            for part in (batch.slice(i, 8192) for i in range(0, batch.num_rows, 8192)):
                fps, keys = key_rows(part.column("fp").to_numpy().view("u8"), golay)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps.view("i8"))], names=["key", "fp"])
    return distinct.select("fp").mapInArrow(run, "key bigint, fp bigint")


class Forest:
    """Union of links between places 0..n-1, in arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def link_forest(cells: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a forest over rows sorted by cell: rows of one cell within ``radius`` bits are connected."""
    names, place = np.unique(fps, return_inverse=True)
    forest = Forest(len(names))
    ends = np.append(np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells))
    end = np.repeat(ends, np.diff(np.append(0, ends)))
    at, step = np.arange(len(cells)), 1
    while len(at):
        at = at[at + step < end[at]]
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        forest.add(place[near], place[near + step])
        step += 1
    moved = np.flatnonzero(forest.root != np.arange(len(names)))
    return names[moved], names[forest.root[moved]]


def links(keys: DataFrame, radius: int = RADIUS, block: int | None = None) -> DataFrame:
    """``a, b``: links that connect all fingerprints of a key that differ in at most ``radius`` bits."""
    block = block or BLOCK
    several = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64("fp", "key"), F.col("n_blocks"))
    met = dealt_join(keys, several, "key").withColumn("n_blocks", n_blocks).withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)))
    cell = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    # Cells are told apart by hash; two in one cell would only be compared in vain.
    dealt = met.select(cell.alias("cell"), "fp").repartition(tasks(keys), "cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fps = np.empty(0, dtype="i8"), np.empty(0, dtype="u8")

        def forest(upto: int) -> pa.RecordBatch:
            a, b = link_forest(cells[:upto], fps[:upto], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], names=["a", "b"])
        for batch in batches:
            cells = np.append(cells, batch.column("cell").to_numpy())
            fps = np.append(fps, batch.column("fp").to_numpy().view("u8"))
            if len(cells) >= GATHER:
                # The last cell may go on in the next batch.
                upto = int(np.searchsorted(cells, cells[-1]))
                if upto:
                    yield forest(upto)
                    cells, fps = cells[upto:], fps[upto:]
        if len(cells):
            yield forest(len(cells))
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5,
                    radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id``, one row per input row.

    ``component_id`` is the smallest id among all documents reachable over links.
    Null and empty texts have fingerprint 0 and are linked with each other like
    any others; very long texts are hashed whole, piece by piece. Repeated rows have one fingerprint; a null id is never the
    smallest unless all are null. Columns beside the two named are not looked at.
    An empty table gives an empty result. ``radius`` is at most 3.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"keys are built for at most {RADIUS} differing bits")
    rows = stored(fingerprints(docs, doc_id, text, words), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(fingerprint_keys(distinct), radius))
    # One row per fingerprint on both sides: none of them is hot, none is broadcast.
    held = distinct.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    held = stored(held, "fingerprint-roots")
    least = held.groupBy("root").agg(F.min("least").alias("component_id"))
    # One row per fingerprint against many documents: a fingerprint that very many share is dealt anew by Spark.
    found = dealt_join(held, least, "root").select("fp", "component_id")
    return dealt_join(rows, found, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5,
                  radius: int = RADIUS) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id (null last), with its own columns.

    Rows are told apart by their place in ``docs``, which must be a stored
    table, so of repeated rows one stays too. Texts meet their verdict by place.
    Null and empty texts are one group; very long texts are hashed whole, piece by
    piece; an empty table gives an empty result; other columns may have any names.
    """
    row, = free_names(docs, "row")
    placed = docs.withColumn(row, F.monotonically_increasing_id())
    # Ids stand for rows here, so that rows of one id and different texts stay apart.
    groups = near_duplicates(placed, row, text, words, radius)
    rank = F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    ids = placed.select(F.col(row).alias("doc_id"), rank.alias("rank"))
    kept = groups.join(ids, "doc_id").groupBy("component_id").agg(F.min("rank")["row"].alias(row))
    return placed.join(kept.select(row), row, "left_semi").select(docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
