"""Hierarchical Pitman-Yor language model over words, by Gibbs-sampled seating.

Every word is drawn in the restaurant of its context, the word before; all
context restaurants share one parent, the root, whose base measure is diffuse (a
new word is a new dish). Restaurants are told apart by ``CONTEXT_BITS`` bits of
the word's hash and grow in number with the text. Both levels have discount 1/2,
for which the number of seatings of n customers at t tables has the closed ratio

    S(n, t + 1) / S(n, t) = 4 (n - t) / (t (2n - t - 1))

so the number of tables of a dish is drawn from its exact conditional, whatever
n is. Counts are dealt by word: all contexts of a word are in one task, where
the root's count of the word is at hand. A context's tables lie in many tasks:
each sends its totals to the task that owns the context (as a word), which adds
them up and sends the sums back, between two rounds of sweeps. Nothing that every
task must know grows with the text. Predictive probabilities are averaged over
the samples.

Texts are read in chunks of bounded size. A chunk sends one entry per distinct
(word, context), however often it occurs. What comes back is the pair's own
customers less discounts, and for each word its count, its tables at the root and
the tables of its restaurant: whole numbers, from which the chunk computes its
probabilities. Chunks are numbered by task and order; they are the same whenever
the stored table is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import stored, tasks

# Bits of a word's hash that name its restaurant.
CONTEXT_BITS = 36
DISCOUNT = 0.5
STRENGTH = 1.0
# Sweeps before the totals are exchanged, before the first sample, and samples.
BURN_IN, SETTLE, SAMPLES = 4, 1, 3
SEED = 7
# Tokens (and documents) that a chunk may hold before it is closed.
CHUNK_TOKENS, CHUNK_DOCS = 1 << 20, 1 << 16
# Bytes of text per word range: what one group holds does not grow with the input.
PART_BYTES = 1 << 24
# Cells of the table of candidate counts worked on at once.
CELLS = 1 << 18


def squeezed(values: np.ndarray) -> bytes:
    """Bytes of like significance side by side, compressed: small or sorted numbers take little room."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values.view("u1").reshape(len(values), -1).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def spread(data: bytes, kind: str = "<u8") -> np.ndarray:
    """The numbers again."""
    if not data:
        return np.zeros(0, dtype=kind)
    planes = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, "u1").reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def whole(values: np.ndarray) -> bytes:
    return squeezed(np.ascontiguousarray(values).astype("<u8"))


def _joined(columns: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype="<u8"), *map(spread, columns)])


def restaurant(words: np.ndarray) -> np.ndarray:
    """Names of the restaurants whose customers follow the words."""
    return words >> np.uint64(64 - CONTEXT_BITS)


def _owner(words: np.ndarray, parts: int) -> np.ndarray:
    """Part of each word; a part is a range of words, cut at borders of 32 bits."""
    return (words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def _ranges(owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and stop of each run of sorted numbers."""
    held, start = np.unique(owner, return_index=True)
    return zip(held.tolist(), start.tolist(), [*start[1:].tolist(), len(owner)])


@dataclass
class Chunk:
    """Documents of one task: token keys and what is asked for them."""

    number: int
    doc_ids: list = field(default_factory=list)
    held: list = field(default_factory=list)
    lengths: list = field(default_factory=list)
    parts: list = field(default_factory=list)
    n: int = 0

    def add(self, doc_id, held: bool, text: bytes) -> None:
        from xxhash import xxh64_digest

        words = text.lower().split()
        # The end of a text is a word no text can hold; it also stands before the first word.
        words.append(b" ")
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.lengths.append(len(words))
        self.parts.append(b"".join(map(xxh64_digest, words)))
        self.n += len(words)

    def close(self) -> None:
        """``words``: sorted distinct; ``word`` and ``before``: places of the words of each distinct pair; ``token``: place of each token's pair."""
        self.words, word = np.unique(np.frombuffer(b"".join(self.parts), dtype=">u8").astype("u8"), return_inverse=True)
        self.parts = []
        pairs, self.token = np.unique(word.astype("u8") << np.uint64(32) | words_before(word, self.lengths).astype("u8"), return_inverse=True)
        self.word, self.before = (pairs >> np.uint64(32)).astype("i8"), (pairs & np.uint64(0xFFFFFFFF)).astype("i8")
        train = np.repeat(~np.array(self.held, dtype=bool), self.lengths)
        self.trained = np.bincount(self.token[train], minlength=len(pairs))

    def split(self, parts: int, own: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes, np.ndarray]]:
        """Part, words, contexts per word, contexts and places of the pairs, for the parts that hold any pair of ``own``."""
        held = np.unique(self.word[own])
        counts = np.bincount(self.word[own], minlength=len(self.words))[held]
        words, contexts = self.words[held], restaurant(self.words[self.before[own]])
        ends = np.append(0, np.cumsum(counts))
        for part, a, b in _ranges(_owner(words, parts)):
            pairs = slice(ends[a], ends[b])
            yield part, squeezed(words[a:b]), whole(counts[a:b]), squeezed(contexts[pairs]), own[pairs]


def words_before(word: np.ndarray, lengths: list[int]) -> np.ndarray:
    """The token before each, inside its text; before the first stands the end."""
    before = np.append(word[-1], word[:-1])
    before[np.cumsum(lengths)[:-1]] = word[-1]
    return before


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Closed chunks of ``doc_id, held, text``."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    chunk = Chunk(number)
    for batch in batches:
        for doc_id, held, text in zip(*(batch.column(c) for c in ("doc_id", "held", "text"))):
            chunk.add(doc_id.as_py(), held.as_py(), text.as_py())
            if chunk.n >= CHUNK_TOKENS or len(chunk.doc_ids) >= CHUNK_DOCS:
                chunk.close()
                yield chunk
                number += 1
                chunk = Chunk(number)
    if chunk.doc_ids:
        chunk.close()
        yield chunk


def text_bytes(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0


def word_ranges(rows: DataFrame, size: int) -> int:
    """Number of parts for ``size`` bytes of text: as many as they ask for, and enough for all tasks."""
    return max(tasks(rows), -(-size // PART_BYTES))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in ddl.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


class Seating:
    """Dishes of one part: customers and tables of each (word, context).

    ``counts`` has the contexts of each word. ``names`` are the restaurants met here.
    """

    def __init__(self, counts: np.ndarray, contexts: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> None:
        self.n, self.t = customers.astype("f8"), tables.astype("f8")
        self.word = np.repeat(np.arange(len(counts)), counts.astype("i8"))
        self.names, self.context = np.unique(contexts, return_inverse=True)

    def table_totals(self) -> np.ndarray:
        """Tables here of each restaurant."""
        return np.bincount(self.context, self.t, minlength=len(self.names))

    def root(self) -> np.ndarray:
        """Customers of the root per word: one for each table."""
        return np.bincount(self.word, self.t)

    def sweep(self, rest: np.ndarray, customers: float, rng: np.random.Generator) -> None:
        """Draw the tables of every dish given all others. A lone customer sits at one table.

        ``rest``: tables that the dish's restaurant has in other parts; ``customers``:
        tables of other parts in all.
        """
        own = np.flatnonzero(self.n > 1)
        n, t, c = self.n[own], self.t[own], self.context[own]
        others = self.root()[self.word[own]] - t
        tables, customers = rest[own] + self.table_totals()[c] - t, customers + self.t.sum() - t

        def log_ratio(k: np.ndarray, i: np.ndarray) -> np.ndarray:
            """ln of the weight of k + 1 tables over that of k."""
            return (np.log(4 * (n[i] - k) / (k * (2 * n[i] - k - 1))) + np.log(STRENGTH + DISCOUNT * (tables[i] + k))
                    + np.log((others[i] + k - DISCOUNT) / (STRENGTH + customers[i] + k)))
        every = np.arange(len(own))
        low, high = np.ones(len(own)), n.copy()
        while (open_ := every[low[every] < high[every]]).size:
            middle = np.floor((low[open_] + high[open_]) / 2)
            rises = log_ratio(middle, open_) >= 0
            low[open_] = np.where(rises, middle + 1, low[open_])
            high[open_] = np.where(rises, high[open_], middle)
            every = open_
        # Around the most likely count; beyond, the weights are below 1e-12.
        reach = np.ceil(10 * np.sqrt(low)) + 10
        first, last = np.maximum(1, low - reach), np.minimum(n, low + reach)
        width = (last - first + 1).astype("i8")
        order = np.argsort(width, kind="stable")
        at, drawn = 0, np.empty(len(own))
        while at < len(order):
            # Dishes of like width side by side, as many as fit.
            wide = int(width[order[at]]) * 5 // 4 + 1
            upto = min(len(order), at + max(1, CELLS // wide), int(np.searchsorted(width[order], wide, side="right")))
            i = order[at:upto]
            wide = int(width[i].max())
            k = first[i][:, None] + np.arange(wide - 1)
            inside = k < last[i][:, None]
            steps = np.where(inside, log_ratio(np.where(inside, k, 1.0), np.broadcast_to(i[:, None], k.shape)), -np.inf)
            weight = np.concatenate([np.zeros((len(i), 1)), np.cumsum(steps, axis=1)], axis=1)
            weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
            drawn[i] = first[i] + (weight < rng.random((len(i), 1)) * weight[:, -1:]).sum(axis=1)
            at = upto
        self.t[own] = np.minimum(drawn, last)


_PACKED = "words binary, counts binary, contexts binary"
_SEATED = f"part bigint, {_PACKED}, n binary, t binary, tables bigint"
_SAMPLED = f"part bigint, {_PACKED}, own binary, count binary, root binary, tables binary, sums array<bigint>"


def seat(docs: DataFrame, parts: int) -> DataFrame:
    """Counts of the training documents per part, seated by ``BURN_IN`` sweeps.

    A part does not know the others' tables yet. Words are dealt by hash, so the
    other dishes of a restaurant are ``parts`` times those here, on average.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield _batch([(*row, whole(chunk.trained[own])) for *row, own in chunk.split(parts, np.flatnonzero(chunk.trained))], _arrow(counted))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        words, counts, contexts, n = (_joined(table.column(c).to_pylist()) for c in ("words", "counts", "contexts", "n"))
        words, place = np.unique(words, return_inverse=True)
        pairs, place = np.unique(np.repeat(place.astype("u8"), counts.astype("i8")) << np.uint64(CONTEXT_BITS) | contexts, return_inverse=True)
        n = np.bincount(place, n)
        counts, contexts = np.bincount((pairs >> np.uint64(CONTEXT_BITS)).astype("i8")), pairs & np.uint64((1 << CONTEXT_BITS) - 1)
        seating, part = Seating(counts, contexts, n, np.ones(len(n))), key[0].as_py()
        rng = np.random.default_rng([SEED, 0, part])
        for _ in range(BURN_IN):
            rest = (parts - 1) * (seating.table_totals()[seating.context] - seating.t)
            seating.sweep(rest, (parts - 1) * seating.t.sum(), rng)
        row = (part, squeezed(words), whole(counts), squeezed(contexts), whole(n), whole(seating.t), int(seating.t.sum()))
        return pa.Table.from_batches([_batch([row], _arrow(_SEATED))])
    counted = f"part bigint, {_PACKED}, n binary"
    # A task for each part: a file of the model holds few of its rows, however many parts there are.
    rows = docs.mapInArrow(count, counted).repartition(parts, "part")
    return rows.groupBy("part").applyInArrow(gather, _SEATED)


def _to_owners(names: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """Owner, start and stop of the restaurants it owns: the part in which their names are words."""
    return _ranges(_owner(names << np.uint64(64 - CONTEXT_BITS), parts))


def rest_tables(model: DataFrame, parts: int) -> DataFrame:
    """Tables of each restaurant over all parts, for the parts that have it: one row per part and owner, in the order of names."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r, = batch.slice(i, 1).to_pylist()
                names, place = np.unique(spread(r["contexts"]), return_inverse=True)
                tables = np.bincount(place, spread(r["t"]))
                yield _batch([(o, r["part"], squeezed(names[a:b]), whole(tables[a:b])) for o, a, b in _to_owners(names, parts)], _arrow(sent))

    def add(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        _, place = np.unique(_joined([r["contexts"] for r in rows]), return_inverse=True)
        total, at, out = np.bincount(place, _joined([r["tables"] for r in rows])), 0, []
        for r in rows:
            size = len(spread(r["tables"]))
            out.append((r["part"], r["owner"], whole(total[place[at:at + size]])))
            at += size
        return pa.Table.from_batches([_batch(out, _arrow(added))])
    sent, added = "owner bigint, part bigint, contexts binary, tables binary", "part bigint, owner bigint, total binary"
    return model.mapInArrow(send, sent).groupBy("owner").applyInArrow(add, added)


def sample(model: DataFrame, parts: int, tables: int) -> DataFrame:
    """``SAMPLES`` seatings of each part, from the exchanged totals on; ``tables`` are those of all parts.

    ``own``: per pair its customers less discounts, in units of the discount, summed
    over samples. ``root`` and ``tables``: tables per word and per restaurant, sample by
    sample. ``sums``: words, tokens, and tables of each sample.
    """
    def run(key: tuple, held: pa.Table, totals: pa.Table) -> pa.Table:
        r, = held.to_pylist()
        counts, contexts, n = spread(r["counts"]), spread(r["contexts"]), spread(r["n"])
        seating = Seating(counts, contexts, n, spread(r["t"]))
        everywhere = _joined([x["total"] for x in sorted(totals.to_pylist(), key=lambda x: x["owner"])])
        rest = (everywhere - seating.table_totals())[seating.context]
        rng, t, root, each, sums = np.random.default_rng([SEED, 1, r["part"]]), np.zeros(len(n)), [], [], []
        for step in range(SETTLE + SAMPLES):
            seating.sweep(rest, tables - r["tables"], rng)
            if step >= SETTLE:
                t += seating.t
                root.append(seating.root())
                each.append(seating.table_totals())
                sums.append(int(seating.t.sum()))
        own = SAMPLES * n.astype("f8") / DISCOUNT - t
        row = (r["part"], r["words"], r["counts"], r["contexts"], whole(own), whole(np.bincount(seating.word, seating.n)),
               whole(np.concatenate(root)), whole(np.concatenate(each)), [len(counts), int(seating.n.sum()), *sums])
        return pa.Table.from_batches([_batch([row], _arrow(_SAMPLED))])
    return model.groupBy("part").cogroup(rest_tables(model, parts).groupBy("part")).applyInArrow(run, _SAMPLED)


def restaurants(samples: DataFrame, parts: int) -> DataFrame:
    """Tables per sample of the restaurants met in each part, sent to their owners: rows like those of ``samples``, without words."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r, = batch.slice(i, 1).to_pylist()
                names = np.unique(spread(r["contexts"]))
                tables = spread(r["tables"]).reshape(SAMPLES, -1)
                yield _batch([(o, squeezed(names[a:b]), whole(tables[:, a:b].ravel())) for o, a, b in _to_owners(names, parts)], _arrow(sent))
    sent = "part bigint, contexts binary, tables binary"
    return samples.select("part", "contexts", "tables").mapInArrow(send, sent)


@dataclass
class Globals:
    """What every task must know: a few numbers."""

    words: int
    tokens: int
    # Tables per sample.
    tables: np.ndarray

    def root_size(self) -> np.ndarray:
        return STRENGTH + self.tables


class Part:
    """The samples of one part, made ready once for all chunks that ask.

    ``rows``: the part's row of samples, if it has training words, and the rows that other parts sent of its restaurants.
    """

    def __init__(self, rows: list[dict]) -> None:
        model = next((r for r in rows if r["words"] is not None), None)
        sent = [r for r in rows if r["words"] is None]
        self.names, place = np.unique(_joined([r["contexts"] for r in sent]), return_inverse=True)
        tables = np.concatenate([np.zeros((SAMPLES, 0)), *(spread(r["tables"]).reshape(SAMPLES, -1) for r in sent)], axis=1)
        self.tables = np.stack([np.bincount(place, x, minlength=len(self.names)) for x in tables])
        self.words, self.count = (spread(model["words"]), spread(model["count"])) if model else (np.zeros(0, "u8"), np.zeros(0, "u8"))
        if model:
            self.root, self.own = spread(model["root"]).reshape(SAMPLES, -1), spread(model["own"])
            self.pairs = np.repeat(np.arange(len(self.words), dtype="u8"), spread(model["counts"]).astype("i8")) << np.uint64(CONTEXT_BITS) | spread(model["contexts"])

    def answer(self, words: np.ndarray, counts: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per word its count, tables at the root, customers and tables of its restaurant; per pair what is its own."""
        count, more = np.zeros(len(words)), np.zeros(len(words))
        root, tables, own = np.zeros((SAMPLES, len(words))), np.zeros((SAMPLES, len(words))), np.zeros(len(contexts))
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            seen = self.words[at] == words
            count[seen], root[:, seen] = self.count[at[seen]], self.root[:, at[seen]]
            # Words that share a restaurant's name share its customers.
            first, last = (np.searchsorted(restaurant(self.words), restaurant(words), side=side) for side in ("left", "right"))
            upto = np.append(0, np.cumsum(self.count.astype("i8")))
            more = upto[last] - upto[first]
            pairs = np.repeat(at.astype("u8"), counts.astype("i8")) << np.uint64(CONTEXT_BITS) | contexts
            place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            met = (self.pairs[place] == pairs) & np.repeat(seen, counts.astype("i8"))
            own[met] = self.own[place[met]]
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, restaurant(words)), len(self.names) - 1)
            seen = self.names[at] == restaurant(words)
            tables[:, seen] = self.tables[:, at[seen]]
        return count, root, more, tables, own


def log_probabilities(known: Globals, word: np.ndarray, before: np.ndarray, root: np.ndarray, customers: np.ndarray, tables: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Averaged log10 probability of each pair of places in the words.

    A word without training tokens has the probability that a new word comes.
    """
    size = known.root_size()[:, None]
    base = np.where(root > 0, root - DISCOUNT, STRENGTH + DISCOUNT * known.words) / size
    backoff, p = STRENGTH + DISCOUNT * tables, own * DISCOUNT / SAMPLES
    for s in range(SAMPLES):
        p += backoff[s][before] * base[s][word] / SAMPLES
    return np.log10(p / (STRENGTH + customers[before]))


def score(docs: DataFrame, held: F.Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    Learns from the rows where ``held`` is not true and scores all. A-Z count as
    a-z; a text is its words and one end. ``base_score`` is an add-1/2 unigram
    model of the same counts, ``score`` the model's log10 probability. Null texts
    count as empty: one end. Repeated rows are counted and scored each; a null
    doc_id is carried along; without training rows every score is that of new
    words only; an empty table gives an empty result. Other columns are not
    looked at. ``docs`` must be a stored table, as its chunks are read three times.
    Words are told apart by 64 bits of hash, restaurants by ``CONTEXT_BITS``.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    parts = word_ranges(rows, text_bytes(rows))
    model = stored(seat(rows, parts), "seating")
    samples = stored(sample(model, parts, model.agg(F.sum("tables")).first()[0] or 0), "seating-samples")
    n_words, n_train, *tables = (x or 0 for x in samples.agg(*[F.sum(F.col("sums")[i]) for i in range(SAMPLES + 2)]).first())
    known = Globals(n_words, n_train, np.array(tables, dtype="f8"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield _batch([(*row, chunk.number) for *row, _ in chunk.split(parts, np.arange(len(chunk.word)))], _arrow(asked))

    def answer(key: tuple, asking: pa.Table, models: pa.Table) -> pa.Table:
        part, out = Part(models.to_pylist()), []
        for r in asking.to_pylist():
            found = part.answer(spread(r["words"]), spread(r["counts"]), spread(r["contexts"]))
            out.append((r["chunk"], r["part"], r["counts"], *(whole(x.ravel()) for x in found)))
        return pa.Table.from_batches([_batch(out, _arrow(answered))])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            yield pa.RecordBatch.from_pylist([{
                "chunk": chunk.number, "doc_ids": chunk.doc_ids, "held": chunk.held, "lengths": chunk.lengths,
                "token": squeezed(chunk.token.astype("<u4"))}], schema=told)

    def add_up(key: tuple, answers: pa.Table, texts: pa.Table) -> pa.Table:
        # Parts are ranges of words, so in their order they are the chunk's words.
        got = sorted(answers.to_pylist(), key=lambda r: r["part"])
        count, more, own = (_joined([r[c] for r in got]).astype("f8") for c in ("count", "customers", "own"))
        root, tables = (np.concatenate([spread(r[c]).reshape(SAMPLES, -1) for r in got], axis=1).astype("f8") for c in ("root", "tables"))
        counts = _joined([r["counts"] for r in got]).astype("i8")
        row, = texts.to_pylist()
        token, word = spread(row["token"], "<u4"), np.repeat(np.arange(len(counts)), counts)
        before = np.zeros(len(word), dtype="i8")
        before[token] = words_before(word[token], row["lengths"])
        logs = log_probabilities(known, word, before, root, more, tables, own)
        base = np.log10((count + 0.5) / (n_train + 0.5 * (n_words + 1)))[word]
        doc = np.repeat(np.arange(len(row["lengths"])), row["lengths"])
        total = {name: np.bincount(doc, x[token]) for name, x in (("n_known", (count > 0)[word]), ("base_score", base), ("score", logs))}
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], id_type), "held_out": row["held"], "n_tokens": pa.array(row["lengths"], pa.int64()),
            "n_known": total["n_known"].astype("i8"), "train_tokens": np.full(len(row["lengths"]), int(n_train)),
            "base_score": total["base_score"], "score": total["score"]})
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    asked = f"part bigint, {_PACKED}, chunk bigint"
    answered = "chunk bigint, part bigint, counts binary, count binary, root binary, customers binary, tables binary, own binary"
    told = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(id_type)), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("token", pa.binary())])
    known_here = samples.select("part", "words", "counts", "contexts", "own", "count", "root").unionByName(restaurants(samples, parts), allowMissingColumns=True)
    answers = rows.mapInArrow(ask, asked).groupBy("part").cogroup(known_here.groupBy("part")).applyInArrow(answer, answered)
    name = kind.simpleString()
    texts = rows.mapInArrow(tell, f"chunk bigint, doc_ids array<{name}>, held array<boolean>, lengths array<bigint>, token binary")
    return answers.groupBy("chunk").cogroup(texts.groupBy("chunk")).applyInArrow(
        add_up, f"doc_id {name}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
