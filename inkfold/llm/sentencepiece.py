"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three machines over characters:

* the normaliser: the model's character map (longest match first) rewrites the text,
  white space becomes the word mark, a mark is put in front; pieces defined by the
  model's user pass through as they are;
* the pieces: a trie whose final states emit a piece id;
* byte fallback: a character no piece holds emits its UTF-8 bytes.

Their composition with an input is a lattice of positions whose arcs are pieces;
the encoding is its shortest path in the tropical semiring. Arc weights depend on
the model:

* unigram: minus the score of the piece;
* BPE: 0 if the piece may follow the piece before it, else infinite. A sequence
  is what merging gives exactly if merging leaves each two neighbours as they
  are (merges inside two neighbours run in the same order whether or not other
  text stands around them). So allowed pairs are a finite automaton over pieces
  and exactly one path is finite, up to every position.

No piece crosses from another character to a word mark, nor over characters that
no longer piece holds, so the lattice falls apart there: each stretch between is
a lattice of its own, and equal stretches have equal paths.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
# Paths and allowed pairs remembered by a worker; beyond, memory starts anew.
REMEMBERED = 1 << 18
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
# What an unknown character costs beyond the worst piece, and how it is shown, and what a piece of the user's costs: fixed values.
UNKNOWN_COST, UNKNOWN_SURFACE, OWN_COST = 10.0, " ⁇ ", 0.1


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, data[at:at + size]
            at += size


def character_map(data: bytes) -> dict[str, str]:
    """What each string of a model's character map becomes.

    The map is a double-array trie of UTF-8 keys, behind its size, and the results,
    each closed by a zero byte. All keys are listed level by level.
    """
    if not data:
        return {}
    size, = struct.unpack_from("<I", data)
    units, results = np.frombuffer(data, "<u4", size // 4, 4).astype("i8"), data[4 + size:]
    # Bits of a unit: label (8, and the top bit, clear), leaf, wide step, step.
    step = (units >> 10) << ((units >> 6) & 8)
    label, leaf = units & 0x800000FF, (units >> 8) & 1
    at, keys, found = step[:1], [b""], {}
    labels = np.arange(1, 256)
    while len(at):
        child = at[:, None] ^ labels
        inside = child < len(units)
        parent, byte = np.nonzero(inside & (label[np.where(inside, child, 0)] == labels))
        nodes = child[parent, byte]
        keys = [keys[i] + bytes((b + 1,)) for i, b in zip(parent.tolist(), byte.tolist())]
        at = nodes ^ step[nodes]
        for i in np.flatnonzero(leaf[nodes]).tolist():
            start = int(units[at[i]] & 0x7FFFFFFF)
            found[keys[i].decode()] = results[start:results.index(b"\0", start)].decode()
    return found


@dataclass
class Model:
    """Pieces and settings of a model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model_type: int = BPE
    byte_fallback: bool = True
    dummy_prefix: bool = True
    trim: bool = False
    unknown: int = 0
    charmap: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def read(data: bytes) -> Model:
        model, normalizer = Model([], [], [], UNIGRAM, False, True, True), {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                model.pieces.append(own[1].decode())
                model.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                model.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(_fields(value))
                model.model_type, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif number == 3:
                # A part that comes twice adds to what came before.
                normalizer |= dict(_fields(value))
        model.dummy_prefix, model.trim = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        model.charmap = character_map(normalizer.get(2, b""))
        if not normalizer.get(5, 1):
            raise ValueError("only models that write white space as a mark are compiled")
        if model.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are compiled")
        model.unknown = model.kinds.index(UNKNOWN)
        return model


class Paths(dict):
    """Ids of the stretches seen; a new one goes through the machine.

    When full, what was seen becomes the older half; stretches still in use come back from there.
    """

    def __init__(self, machine: Transducer) -> None:
        self.machine = machine
        self.older: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        found = self.older.get(stretch)
        if found is None:
            found = self.machine._emit(self.machine.shortest_path(stretch))
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        # Long stretches hardly come twice.
        if len(stretch) <= 64:
            self[stretch] = found
        return found


class Decoder:
    """What the pieces of a model look like; ``decode`` works on one text."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.surfaces = [self._surface(i) for i in range(len(model.pieces))]

    def _surface(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return UNKNOWN_SURFACE.encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """Text of piece ids; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.surfaces.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


class Transducer(Decoder):
    """The compiled machine of a model; ``encode`` and ``decode`` work on one text."""

    def __init__(self, model: Model) -> None:
        super().__init__(model)
        normal = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == NORMAL}
        self.own = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == USER}
        # Merging leaves pieces of the user's alone; in a unigram lattice they are arcs that win.
        self.ids = normal | self.own if model.model_type == UNIGRAM else normal
        # Kinds come with the pieces, so bytes are found by their order.
        at = [i for i, k in enumerate(model.kinds) if k == BYTE]
        self.bytes = {int(model.pieces[i][3:5], 16): i for i in at}
        # The library counts the best score as 0 at least.
        scores = [model.scores[i] for i in normal.values()]
        self.rank = {p: len(p.encode()) * max([0.0, *scores]) - OWN_COST if p in self.own else model.scores[i] for p, i in self.ids.items()}
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i
        self.unknown_cost = UNKNOWN_COST - min(scores, default=0.0)
        long_chars = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\r\t" if c not in long_chars)
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        gap = f"[{re.escape(alone)}]|" if alone else ""
        self.stretch = re.compile(".+" if crossing else f"{gap}{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+", re.S).findall
        self.single = {ord(k): v for k, v in model.charmap.items() if len(k) == 1}
        self.several = {k: v for k, v in model.charmap.items() if len(k) > 1}
        self.widest = max(map(len, self.several), default=0)
        user = "|".join(re.escape(p) for p in sorted(self.own, key=len, reverse=True))
        self.user = re.compile(f"({user})", re.S) if user else None
        # Where more than one character may be matched at once.
        first, second = ("".join(sorted({re.escape(k[i]) for k in self.several})) for i in (0, 1))
        places = [f"({user})" if user else "((?!))", *([f"[{first}](?=[{second}])"] if self.several else [])]
        self.places = re.compile("|".join(places), re.S) if user or self.several else None
        self.paths = Paths(self)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.stories: dict[str, tuple] = {}

    # Normaliser -------------------------------------------------------------

    def mapped(self, text: str) -> str:
        """The text through the character map; at each place a piece of the user's comes first, then the longest match."""
        if not self.places:
            return text.translate(self.single) if self.single else text
        out, done, at = [], 0, 0
        while place := self.places.search(text, at):
            start = place.start()
            end = place.end() if place[1] else next(
                (e for e in range(min(len(text), start + self.widest), start + 1, -1) if text[start:e] in self.several), None)
            if end is None:
                at = start + 1
                continue
            out += [text[done:start].translate(self.single), place[1] or self.several[text[start:end]]]
            done = at = end
        out.append(text[done:].translate(self.single))
        return "".join(out)

    def normalize(self, text: str) -> str:
        empty = not text
        text = self.mapped(text)
        if self.model.trim:
            text = re.sub(" +", " ", text.strip(" "))
            empty = not text
        if empty:
            return ""
        text = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        return text.rstrip(MARK) if self.model.trim else text

    # Pieces -----------------------------------------------------------------

    def merged(self, piece: str) -> tuple[bool, list[tuple[float, str]], list[tuple[float, str]]]:
        """How merging builds a piece: best score first, leftmost on ties.

        Gives whether it arrives at the whole piece, and its merges in order:
        the score of each with the last (and the first) part standing before it.
        """
        rank, none = self.rank.get, -np.inf
        parts = list(piece)
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        lasts, firsts = [], []
        while ranks and (best := max(ranks)) > none:
            lasts.append((best, parts[-1]))
            firsts.append((best, parts[0]))
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
        lasts.append((none, parts[-1]))
        firsts.append((none, parts[0]))
        return len(parts) == 1, lasts, firsts

    def story(self, piece: str) -> tuple[bool, list[tuple[float, str]], list[tuple[float, str]]]:
        found = self.stories.get(piece)
        if found is None:
            if len(self.stories) >= REMEMBERED:
                self.stories.clear()
            found = self.stories[piece] = self.merged(piece)
        return found

    def allowed(self, before: str, piece: str) -> bool:
        """Whether merging leaves ``before`` and ``piece`` as they are (weight 0, else infinite).

        Both are built side by side, the better merge first; they would be
        joined if at some moment the parts at their border made the best merge.
        """
        stays, _, firsts = self.story(piece)
        if stays and before:
            lasts, rank, none = self.story(before)[1], self.rank.get, -np.inf
            i = j = 0
            while True:
                left, last = lasts[i]
                right, first = firsts[j]
                border = rank(last + first, none)
                # On ties the leftmost merge comes first.
                if border > left and border >= right:
                    stays = False
                    break
                if left >= right:
                    if left == none:
                        break
                    i += 1
                else:
                    j += 1
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        self.pairs[before, piece] = stays
        return stays

    def _ends(self, text: str, at: int) -> list[int]:
        """Where the pieces that begin at a place end, shortest first; an unknown character is an arc too."""
        node, end, n, ends = self.trie, at, len(text), []
        while end < n:
            node = node.get(text[end])
            if node is None:
                break
            end += 1
            if "" in node:
                ends.append(end)
        if text[at] not in self.ids:
            ends.insert(0, at + 1)
        return ends

    def finite_path(self, text: str) -> list[str]:
        """The only path of finite weight of a BPE lattice.

        All finite arcs weigh 0, so the first path that reaches the end is the
        shortest. Long arcs are followed first. There is one finite path to a
        position at most, so a position is left for good once it leads nowhere.
        """
        n, pairs = len(text), self.pairs.get
        back: list[str | None] = [""] + [None] * n
        trail = [(0, self._ends(text, 0))]
        while back[n] is None:
            at, ends = trail[-1]
            if not ends:
                trail.pop()
                continue
            end = ends.pop()
            if back[end] is None:
                before, piece = back[at], text[at:end]
                good = pairs((before, piece))
                if good or good is None and self.allowed(before, piece):
                    back[end] = piece
                    if end < n:
                        trail.append((end, self._ends(text, end)))
        return self._along(back)

    def weighted_path(self, text: str) -> list[str]:
        """The path of least weight of a unigram lattice; ties go to the arc found first."""
        n = len(text)
        cost, back = [0.0] + [np.inf] * n, [""] * (n + 1)
        for at in range(n):
            for end in self._ends(text, at):
                weight = cost[at] - self.rank.get(text[at:end], -self.unknown_cost)
                if weight < cost[end]:
                    cost[end], back[end] = weight, text[at:end]
        return self._along(back)

    @staticmethod
    def _along(back: list) -> list[str]:
        path, n = [], len(back) - 1
        while n:
            path.append(back[n])
            n -= len(back[n])
        return path[::-1]

    def shortest_path(self, text: str) -> list[str]:
        """Pieces (or unknown single characters) of the best path."""
        return self.weighted_path(text) if self.model.model_type == UNIGRAM else self.finite_path(text)

    def _emit(self, path: list[str]) -> bytes:
        out: list[int] = []
        for piece in path:
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            elif self.model.byte_fallback:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(self.model.unknown)
        return array("i", out).tobytes()

    def _emitted(self, text: str) -> Iterator[bytes]:
        if not self.user or self.model.model_type == UNIGRAM:
            return map(self.paths.__getitem__, self.stretch(text))
        # Pieces of the user's stand at odd places; what lies between is merged on its own.
        return (array("i", [self.own[part]]).tobytes() if i % 2 else b"".join(map(self.paths.__getitem__, self.stretch(part)))
                for i, part in enumerate(self.user.split(text)))

    def encode(self, text: str) -> bytes:
        """Piece ids as 32-bit numbers of this machine's byte order."""
        found = b"".join(self._emitted(self.normalize(text)))
        if self.model.byte_fallback:
            return found
        # Unknown characters side by side are one unknown piece.
        ids = np.frombuffer(found, "i4")
        unknown = ids == self.model.unknown
        return ids[~(unknown & np.append(False, unknown[:-1]))].tobytes()


@lru_cache(maxsize=1)
def _transducer(model: bytes) -> Transducer:
    """The machine of a worker process: its tasks share it, so no task compiles or leaves behind one of its own."""
    return Transducer(Model.read(model))


@lru_cache(maxsize=1)
def _decoder(model: bytes) -> Decoder:
    return Decoder(Model.read(model))


def encode(texts: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``texts`` and ``ids`` (array of int), row by row, without a shuffle.

    A null text has null ids, an empty one an empty list. The word mark itself,
    when it occurs in a text, is read as a space. A column that is called like
    ``ids`` is replaced. Texts are encoded whole; what a worker remembers is bounded.
    """
    rest = [c for c in texts.columns if c != ids]
    rows = texts.select(rest)
    schema = T.StructType([*rows.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(model)
        for batch in batches:
            given = batch.column(rest.index(text))
            # Numbers are listed in parts, so that a batch of long texts is not held twice.
            for at in range(0, batch.num_rows, 512):
                part = given.slice(at, 512)
                found = [None if t is None else machine.encode(t) for t in part.to_pylist()]
                ends = np.cumsum([0] + [len(f or b"") // 4 for f in found], dtype="i4")
                values = pa.array(np.frombuffer(b"".join(f or b"" for f in found), dtype="i4"))
                mask = pa.array([f is None for f in found])
                lists = pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)
                yield pa.RecordBatch.from_arrays([*batch.slice(at, 512).columns, lists], names=[*rest, ids])
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text of ``ids``; null ids have a null text.

    Control pieces are silent, ids outside the model and null ids inside a list
    are an error. A column that is called like ``text`` is replaced.
    """
    rest = [c for c in rows.columns if c != text]
    rows = rows.select(rest)
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _decoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [None if x is None else machine.decode(x) for x in _lists(part.column(rest.index(ids)))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=[*rest, text])
    return rows.mapInArrow(run, schema)


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    for row in column:
        yield row.values.to_numpy().tolist() if row.is_valid else None


def model_bytes(path: str) -> bytes:
    """A model file; it is read once by the driver and travels with the job."""
    with open(path, "rb") as f:
        return f.read()
