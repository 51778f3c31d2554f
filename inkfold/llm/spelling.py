"""Spelling variants found by pivotal grams: words one edit apart, and the form each goes back to.

Bigrams are ordered from rare to frequent over the whole vocabulary. The prefix of
a word are its three rarest bigrams (and a few that tie with the third); two of
them that share no character are its pivots, the pair of least total frequency,
chosen by dynamic programming. One edit spoils one pivot at most. So of two words
one edit apart, the one whose prefix ends with the rarer bigram (either, on ties) has
a pivot that stands unharmed in the other's prefix.

Position limits: either the edit lies behind the first pivot, and all up to its end
agrees, or it lies before the second, and all from its start agrees. So a pivot and a
prefix bigram meet only under the whole agreeing side, whose length fixes the position
from that end, and lengths differ by one at most. One edit also changes at most two
letters and four bigrams, which is read off parities before words are verified by
their edit distance.

A side under which very many words meet is cut into blocks: prefix words are dealt
to some, pivots to others, and each pair of blocks is a group of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import islice
from operator import add
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from inkfold.llm.common import stored, tasks

GRAM, EDITS = 2, 1
# Words of one side (prefix or pivots) that one group of candidates holds.
BLOCK = 1024
# Rows gathered before groups are worked on, and pairs looked at side by side.
GATHER, PAIRS = 1 << 16, 1 << 20
MIN_LENGTH, MIN_COUNT, FACTOR, ROT = 7, 2, 10, 31
# Runs of letters of texts lower-cased in A-Z, at least as long as a word.
RUN = re.compile("[a-z\u00c0-\u00ff]{%d,}+" % MIN_LENGTH)
# Forms grow tenfold in count, so a chain of them is shorter than 2^5 steps for any 64-bit count.
DOUBLINGS = 5
# Distinct words a task remembers between two outputs.
HELD = 1 << 18


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all runs of letters, one in 31 of a document's distinct ones with a letter left out.

    Runs are lower-cased in A-Z only. A run shorter than a word cannot become one and is not
    looked at. Null and empty texts have none; a null id counts as empty text.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch
        for batch in batches:
            for own, body in zip(batch.column("doc_id"), batch.column("text")):
                head = crc32(own.as_py().encode() + b":")
                # Bytes are lower-cased in A-Z only.
                for word, n in Counter(RUN.findall(body.as_py().lower().decode())).items():
                    mark = crc32(word.encode(), head)
                    if mark % ROT == 0:
                        at = mark % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= MIN_LENGTH:
                        held[word] += n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def gram_order(words: DataFrame, word: str = "word") -> dict[str, int]:
    """Frequency of every bigram over the distinct words.

    The letters are at most 58 (a-z and 32 of U+00E0 to U+00FF) and those of upper
    case beyond ASCII, 90 in all, so there are 8,100 bigrams at most in any corpus.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for own in batch.column(0).to_pylist():
                held.update(map(add, own, own[1:]))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "n"])
    grams = words.select(word).mapInArrow(run, "gram string, n bigint")
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def pivots(places: list[int], cost: Mapping[int, int], wanted: int = EDITS + 1) -> list[int]:
    """``wanted`` places of bigrams, no two overlapping, of least total cost (the leftmost on ties).

    ``best[k]`` is the cheapest choice of k among the places passed so far that end before the next.
    """
    best: list[list[tuple[int, tuple[int, ...]]]] = [[(0, ())] + [(1 << 62, ())] * wanted]
    for i, place in enumerate(places):
        fits = next((j for j in range(i, 0, -1) if places[j - 1] + GRAM <= place), 0)
        row = list(best[i])
        for k in range(1, wanted + 1):
            before, chosen = best[fits][k - 1]
            if len(chosen) == k - 1:
                row[k] = min(row[k], (before + cost[place], (*chosen, place)))
        best.append(row)
    return list(best[-1][wanted][1])


class Entries(NamedTuple):
    """How a word stands in the index."""

    last: tuple[int, str]
    prefix: list[int]
    pivots: list[int]


def entries(word: str, freq: Mapping[str, int]) -> Entries:
    """Ordered by frequency, the gram itself and its place, the first three places hold the pivots.

    Where the third bigram occurs more often than that, another word's pivot may be any of
    its first three, and one edit adds two at most before it: five of them are listed.
    """
    order = [(freq.get(word[i:i + GRAM], 0), word[i:i + GRAM]) for i in range(len(word) - 1)]
    first = sorted(zip(order, range(len(order))))[:GRAM * EDITS + 1]
    last = first[-1][0]
    prefix = [i for o, i in first if o < last]
    prefix += islice((i for i, o in enumerate(order) if o == last), GRAM * EDITS + 1 + GRAM * EDITS)
    places = sorted(i for _, i in first)
    return Entries(last, prefix, pivots(places, {i: order[i][0] for i in places}))


def parities(word: str) -> tuple[int, int]:
    """Bits of letters, and of bigrams, that occur an odd number of times; the sign bit stays free."""
    letters = grams = 0
    last = 0
    for c in map(ord, word):
        letters ^= 1 << (c % 62)
        if last:
            grams ^= 1 << ((last * 31 + c) % 61)
        last = c
    return letters, grams


def _side(text: str) -> int:
    return xxh64_intdigest(text) - (1 << 63)


def index(words: DataFrame) -> DataFrame:
    """``word, last, letters, grams, asks, side``: a row per word, bigram and side.

    Prefix bigrams stand under both sides (``asks`` false), the first pivot under the
    word up to its end and the second under the word from its start (``asks`` true).
    ``last`` is the rank of the last prefix bigram.
    """
    freq = gram_order(words)
    rank = {gram: i for i, gram in enumerate(sorted(freq, key=lambda g: (freq[g], g)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                sides, asks, counts, facts = [], [], [], []
                for word in part.column("word").to_pylist():
                    own = entries(word, freq)
                    first, second = min(own.pivots), max(own.pivots)
                    sides += [_side("<" + word[:first + GRAM]), _side(">" + word[second:])]
                    for at in own.prefix:
                        sides += [_side("<" + word[:at + GRAM]), _side(">" + word[at:])]
                    asks += [True, True] + [False] * (2 * len(own.prefix))
                    counts.append(2 + 2 * len(own.prefix))
                    facts.append((rank[own.last[1]], *parities(word)))
                at = np.repeat(np.arange(part.num_rows), counts)
                last, letters, grams = np.array(facts, dtype="u8").reshape(-1, 3)[at].T
                yield pa.RecordBatch.from_arrays(
                    [part.column("word").take(pa.array(at)), pa.array(last.astype("i4")), pa.array(letters.astype("i8")),
                     pa.array(grams.astype("i8")), pa.array(asks), pa.array(sides, pa.int64())],
                    names=["word", "last", "letters", "grams", "asks", "side"])
    return words.select("word").mapInArrow(run, "word string, last int, letters bigint, grams bigint, asks boolean, side bigint")


def _meet(cells: np.ndarray, asks: np.ndarray, last: np.ndarray, size: np.ndarray, letters: np.ndarray,
          grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of asking and held rows of one cell that may be one edit apart; rows are sorted by cell."""
    ends = np.append(np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells))
    starts = np.append(0, ends[:-1])
    cell = np.repeat(np.arange(len(ends)), ends - starts)
    held = np.flatnonzero(~asks)
    n_held = np.bincount(cell[held], minlength=len(ends))
    first = np.cumsum(n_held) - n_held
    asking = np.flatnonzero(asks)
    upto = np.cumsum(n_held[cell[asking]])
    out_a, out_b, done = [], [], 0
    while done < len(asking):
        # So many asking rows that their pairs fit; one row alone has a block of them at most.
        base = upto[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(upto, base + PAIRS, side="right")))
        own = asking[done:stop]
        n = n_held[cell[own]]
        a = np.repeat(own, n)
        b = held[np.repeat(first[cell[own]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        keep = np.bitwise_count(grams[a] ^ grams[b]) <= 4 * EDITS
        a, b = a[keep], b[keep]
        keep = (np.bitwise_count(letters[a] ^ letters[b]) <= 2 * EDITS) & (np.abs(size[a] - size[b]) <= EDITS) & (last[a] <= last[b])
        out_a.append(a[keep])
        out_b.append(b[keep])
        done = stop
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (held[:0], held[:0])


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: all pairs of distinct words one inserted, deleted or replaced code point apart, in both orders.

    ``words`` holds distinct ``word`` of four code points or more (two bigrams apart), not null.
    """
    listed = stored(index(words), "spelling-index")
    sides = listed.groupBy("side").agg(F.count_if(~F.col("asks")).alias("n_held"), F.count_if("asks").alias("n_asks"))
    hot = sides.where((F.col("n_held") > BLOCK) | (F.col("n_asks") > BLOCK))
    met = listed.join(hot, "side", "left")
    n_held, n_asks = (F.coalesce(F.ceil(F.col(n) / BLOCK), F.lit(1)) for n in ("n_held", "n_asks"))
    own = F.pmod(F.xxhash64("word"), F.when(F.col("asks"), n_asks).otherwise(n_held))
    others = F.sequence(F.lit(0).cast("bigint"), F.when(F.col("asks"), n_held).otherwise(n_asks) - 1)

    def cell(other: Column) -> Column:
        one, two = F.when(F.col("asks"), own).otherwise(other), F.when(F.col("asks"), other).otherwise(own)
        return F.when(F.col("n_held").isNull(), F.col("side")).otherwise(F.xxhash64("side", one, two))
    # Cells are told apart by hash; two in one cell would only be compared in vain.
    rows = met.select("word", "last", "letters", "grams", "asks", F.explode(F.transform(others, cell)).alias("cell"))
    dealt = rows.repartition(tasks(words), "cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def pairs(table: pa.Table) -> pa.RecordBatch:
            word = table.column("word").combine_chunks()
            a, b = _meet(*(table.column(c).to_numpy() for c in ("cell", "asks", "last")), pc.utf8_length(word).to_numpy(),
                         *(table.column(c).to_numpy() for c in ("letters", "grams")))
            return pa.RecordBatch.from_arrays([word.take(pa.array(a)), word.take(pa.array(b))], names=["a", "b"])
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= GATHER:
                # The last cell may go on in the next batch.
                table = pa.Table.from_batches(waiting)
                cells = table.column("cell").to_numpy()
                upto = int(np.searchsorted(cells, cells[-1]))
                if upto:
                    yield pairs(table.slice(0, upto))
                    waiting = table.slice(upto).to_batches()
        if waiting:
            yield pairs(pa.Table.from_batches(waiting))
    near = dealt.mapInArrow(run, "a string, b string").where(F.levenshtein("a", "b", EDITS) == 1)
    both = F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return near.select(both).distinct()


def variants(counts: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct ``word, n``.

    A word's form is its most frequent near word (the first in code-point order on
    ties), if that is at least ``factor`` times as frequent; the root is where forms
    lead from the word, itself if nowhere. An empty table gives an empty result.
    """
    counts = stored(counts.select("word", "n"), "spelling-words")
    near = stored(near_pairs(counts), "spelling-near")
    named = near.join(counts.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = named.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b"))).alias("m"))
    rows = counts.join(best, "word", "left")
    takes = -F.col("m.n") >= factor * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                              F.when(takes, F.col("m.b")).alias("form"), F.when(takes, -F.col("m.n")).alias("form_n")), "spelling-forms")
    jump = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        ahead = jump.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if jump.join(ahead, "root").isEmpty():
            break
        jump = stored(jump.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return rows.join(jump, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """``variants`` of the words of all texts that occur ``min_count`` times or more.

    Words have seven code points at least. Null and empty texts hold no words; very
    long ones are read whole; repeated rows count each; an empty table gives an empty
    result; other columns are not looked at.
    """
    return variants(word_counts(docs, doc_id, text).where(F.col("n") >= min_count))
