"""Text expressions: white space, words, character and word error rates.

Very short pairs are scored by Spark's own ``levenshtein``; its cost grows with the
product of the two lengths, so longer pairs go through an Arrow UDF around a
bit-parallel edit distance (about 1/64 of the cell work): pairs of up to
``BATCH_ITEMS`` items many at a time, longer ones one by one. All give the same
exact number, no text is cut.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain
from operator import ne

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as str.strip() and Python's \s see it.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_WHITE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Pairs up to this many characters together stay in the JVM.
NATIVE_CHARS = 64
# One character per distinct word of such a pair.
_WORD_CODES = "".join(chr(0x100 + i) for i in range(NATIVE_CHARS))
# Sequences above this many items are first tried in a band around the diagonal.
BAND_ITEMS = 2_500
# Pairs of sequences up to this many items are compared many at a time, so many in one step.
BATCH_ITEMS, BATCH_PAIRS = 128, 2_048
# Above this many items bounds that may settle the distance are tried first.
BOUND_ITEMS = 64


def strip_ends(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITE_CHARS))


def text_normalize(text: Column) -> Column:
    """Runs of two or more white-space characters become one space; ends stripped."""
    return strip_ends(F.regexp_replace(text, f"[{WHITE}]{{2,}}", " "))


def words(text: Column) -> Column:
    """Words of a text, split on the space only: a lone newline stays in its word."""
    return F.array_remove(F.split(text_normalize(text), " "), "")


def tokens(text: Column) -> Column:
    """Tokens of a caption, split on any white space; dots stay on their token."""
    return F.array_remove(F.split(text, f"[{WHITE}]+"), "")


def edit_distance(a, b) -> int:
    """Exact edit distance of two sequences of hashable items, bit-parallel."""
    if len(a) < len(b):
        a, b = b, a
    if not len(b):
        return len(a)
    # Equal ends never change the distance.
    low, shorter = 0, len(b)
    while low < shorter and a[low] == b[low]:
        low += 1
    high = 0
    while high < shorter - low and a[-1 - high] == b[-1 - high]:
        high += 1
    a, b = a[low:len(a) - high], b[low:shorter - high]
    if not len(b):
        return len(a)

    size, gap = len(a), len(a) - len(b)
    if size > BOUND_ITEMS:
        found = settled_distance(a, b)
        if found is not None:
            return found
    positions: dict = {}
    for i, item in enumerate(a):
        positions.setdefault(item, []).append(i)
    cut = _match_cutter(positions, size)
    slack = max(64, size >> 4)
    while size > BAND_ITEMS and (gap + slack) * 3 < size * 2:
        found = _distance_in_band(cut, gap, b, slack // 2)
        if found is not None:
            return found
        slack *= 4
    return _distance_in_table(cut, size, b)


def settled_distance(a, b) -> int | None:
    """The edit distance of ``a`` and ``b`` (not longer) where a few passes settle it, else None.

    An alignment gives a bound from above: ``b`` found in ``a`` item by item; or all items in
    place; or, where the items both sides know stand in the same order, these kept and what lies
    between them replaced. From below it is the difference of the lengths, or the items of ``a``
    that ``b`` does not have as often. Where both bounds agree that is the distance.
    """
    rest = iter(a)
    if all(item in rest for item in b):
        return len(a) - len(b)
    least = sum((Counter(a) - Counter(b)).values())
    if len(a) == len(b) and sum(map(ne, a, b)) == least:
        return least
    in_a, in_b = set(a), set(b)
    at = [i for i, item in enumerate(a) if item in in_b]
    on = [j for j, item in enumerate(b) if item in in_a]
    if len(at) != len(on) or any(a[i] != b[j] for i, j in zip(at, on)):
        return None
    between = np.maximum(np.diff(at, prepend=-1, append=len(a)), np.diff(on, prepend=-1, append=len(b))) - 1
    return least if int(between.sum()) == least else None


def _match_bits(where, low: int, width: int) -> int:
    """Positions from ``low`` on, below ``low + width``, as bits of a number."""
    bits = bytearray((width >> 3) + 1)
    for i in where[bisect_left(where, low):bisect_left(where, low + width)]:
        i -= low
        bits[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(bits, "little")


# Match bits held at once for one pair; beyond that they are made when needed.
_KEPT_BITS = 1 << 29


def _match_cutter(positions: dict, size: int):
    """Function from (item, low, width) to the match bits of that stretch."""
    if len(positions) * size > _KEPT_BITS:
        return lambda item, low, width: _match_bits(positions.get(item, ()), low, width)
    whole = {item: _match_bits(where, 0, size) for item, where in positions.items()}

    def cut(item, low: int, width: int) -> int:
        bits = whole.get(item, 0)
        return (bits >> low if low >= 0 else bits << -low) & ((1 << width) - 1)

    return cut


def _distance_in_table(cut, size: int, b) -> int:
    """Bit-parallel columns of the whole table: +1 and -1 steps down a column as bits."""
    full = (1 << size) - 1
    plus, minus = full, 0
    kept: dict = {}
    find, room = kept.get, max(256, _KEPT_BITS // size)
    for item in b:
        same = find(item)
        if same is None:
            same = cut(item, 0, size)
            if len(kept) < room:
                kept[item] = same
        diagonal = (((same & plus) + plus) ^ plus) | same | minus
        right = (minus | (full & ~(diagonal | plus))) << 1 | 1
        plus = ((diagonal & plus) << 1 | ~(diagonal | right)) & full
        minus = diagonal & right & full
    return len(b) + plus.bit_count() - minus.bit_count()


# Columns that share one cut of the match bits.
_BAND_STEP = 512


def _distance_in_band(cut, gap: int, b, side: int) -> int | None:
    """The same columns, only within ``side`` cells around the diagonals 0 to ``gap``.

    An alignment of up to ``gap + 2 * side`` edits never leaves that band, so a
    distance found within this bound is exact; above it None is returned.
    The band moves down one row per column. Rows before the first one carry
    -1 steps, which keeps the first row counting insertions.
    """
    width = gap + 2 * side + 1
    full, edge, end = (1 << width) - 1, 1 << (width - 1), side + gap
    minus = (1 << (side + 1)) - 1
    plus = full ^ minus
    distance, bound = gap, gap + 2 * side
    for start in range(0, len(b), _BAND_STEP):
        cuts: dict = {}
        for offset, item in enumerate(b[start:start + _BAND_STEP]):
            bits = cuts.get(item)
            if bits is None:
                bits = cuts[item] = cut(item, start - side, width + _BAND_STEP)
            same = bits >> offset & full
            plus, minus = plus >> 1 | edge, minus >> 1
            diagonal = ((((same & plus) + plus) ^ plus) | same | minus) & full
            distance += ~diagonal >> end & 1
            right = (minus | (full ^ (diagonal | plus))) << 1 | 1
            left = (diagonal & plus) << 1
            plus = (left | ~(diagonal | right)) & full
            minus = diagonal & right
        if distance > bound:
            return None
    return distance


_COUNTS = T.StructType([T.StructField("edits", T.LongType()), T.StructField("items", T.LongType())])


def _normal_words(text: str) -> list[str]:
    return [w for w in re.sub(r"\s\s+", " ", text).strip().split(" ") if w]


def _padded(sequences: list) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the items of texts, or of lists of numbers, one row each, and the lengths; rows end with zeros."""
    sizes = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
    if isinstance(sequences[0], str):
        flat = np.frombuffer("".join(sequences).encode("utf-32-le"), dtype="<u4")
    else:
        flat = np.fromiter(chain.from_iterable(sequences), dtype="<u4", count=int(sizes.sum()))
    # Numbers as narrow as they can be.
    top = int(flat.max(initial=0))
    rows = np.zeros((len(sequences), -(-max(int(sizes.max()), 1) // 64) * 64), dtype="u1" if top < 256 else "<u2" if top < 65536 else "<u4")
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = flat
    return rows, sizes


def _batches(pairs: list[tuple]) -> Iterator[np.ndarray]:
    """Places of pairs that are compared in one step, those of like size together, longest second first."""
    # By the words of bits the first takes, then by the items of the second.
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]) + 63 >> 6, len(pairs[i][1])), reverse=True)
    at = 0
    while at < len(order):
        width, upto = len(pairs[order[at]][0]) + 63 >> 6, at
        while upto < len(order) and upto < at + BATCH_PAIRS and len(pairs[order[upto]][0]) + 63 >> 6 == width:
            upto += 1
        yield np.array(order[at:upto])
        at = upto


def batch_distances(pairs: list[tuple]) -> list[int]:
    """Edit distances of many pairs of short texts, or of lists of numbers: the same columns as in a table, for all pairs at once."""
    found = np.zeros(len(pairs), dtype=np.int64)
    one, last = np.uint64(1), np.uint64(63)
    for batch in _batches(pairs):
        a, a_sizes = _padded([pairs[i][0] for i in batch])
        b, b_sizes = _padded([pairs[i][1] for i in batch])
        words = a.shape[1] // 64
        wide = np.promote_types(a.dtype, b.dtype)
        a, b = a.astype(wide, copy=False), np.ascontiguousarray(b.astype(wide, copy=False).T)
        plus = np.full((words, len(batch)), np.iinfo(np.uint64).max, dtype=np.uint64)
        minus = np.zeros_like(plus)
        # Pairs whose second still has an item stand in front.
        going = np.searchsorted(-b_sizes, -np.arange(int(b_sizes.max())), side="left")
        for j, k in enumerate(going.tolist()):
            bits = np.packbits(a[:k] == b[j, :k, None], axis=1, bitorder="little").view("<u8")
            carry = minus_in = np.zeros(k, dtype=np.uint64)
            plus_in = np.ones(k, dtype=np.uint64)
            for w in range(words):
                same, p, m = bits[:, w], plus[w, :k], minus[w, :k]
                total = (same & p) + p
                over = total < p
                total += carry
                carry = (over | (total < carry)).astype(np.uint64)
                diagonal = (total ^ p) | same | m
                right, left = m | ~(diagonal | p), p & diagonal
                right_on, left_on = right << one | plus_in, left << one | minus_in
                plus_in, minus_in = right >> last, left >> last
                plus[w, :k] = left_on | ~(diagonal | right_on)
                minus[w, :k] = right_on & diagonal
        # Steps down the last column; bits beyond the first's end do not count.
        size = a_sizes - 64 * np.arange(words)[:, None]
        inside = np.where(size >= 64, ~np.uint64(0), (one << np.clip(size, 0, 63).astype(np.uint64)) - one)
        found[batch] = b_sizes + np.bitwise_count(plus & inside).sum(axis=0, dtype=np.int64) - np.bitwise_count(minus & inside).sum(axis=0, dtype=np.int64)
    return found.tolist()


def _numbered(pairs: list[tuple]) -> list[tuple]:
    """Lists of words as lists of numbers, equal words with equal numbers."""
    codes: defaultdict = defaultdict(lambda: len(codes) + 1)
    number = codes.__getitem__
    return [(list(map(number, a)), list(map(number, b))) for a, b in pairs]


def distances(pairs: list[tuple]) -> list[int]:
    """Edit distances of pairs of texts, or of lists of words; short pairs many at a time."""
    short = [i for i, (a, b) in enumerate(pairs) if len(a) <= BATCH_ITEMS and len(b) <= BATCH_ITEMS]
    found = [-1] * len(pairs)
    some = [pairs[i] for i in short]
    for i, edits in zip(short, batch_distances(some if not some or isinstance(some[0][0], str) else _numbered(some))):
        found[i] = edits
    return [edit_distance(*pairs[i]) if edits < 0 else edits for i, edits in enumerate(found)]


# Characters whose items a task holds at once.
_HELD_CHARS = 1 << 21


def _stretches(rows: list[tuple], size) -> Iterator[list[tuple]]:
    """The rows in stretches of bounded size, a larger row alone."""
    at = held = 0
    for i, row in enumerate(rows):
        held += size(row)
        if held > _HELD_CHARS and i > at:
            yield rows[at:i]
            at, held = i, size(row)
    if at < len(rows):
        yield rows[at:]


def _both(row: tuple) -> int:
    return len(row[0] or "") + len(row[1] or "")


def _counts(truth: pd.Series, result: pd.Series, items) -> pd.DataFrame:
    found = []
    for rows in _stretches([*zip(truth, result)], _both):
        pairs = [None if a is None or b is None else (items(a), items(b)) for a, b in rows]
        edits = iter(distances([p for p in pairs if p]))
        found += [(None, None) if p is None else (next(edits), len(p[0])) for p in pairs]
    return pd.DataFrame(found, columns=_COUNTS.names, dtype="Int64")


@F.pandas_udf(_COUNTS)
def _char_counts_arrow(truth: pd.Series, result: pd.Series) -> pd.DataFrame:
    return _counts(truth, result, str.strip)


@F.pandas_udf(_COUNTS)
def _word_counts_arrow(truth: pd.Series, result: pd.Series) -> pd.DataFrame:
    return _counts(truth, result, _normal_words)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where lambdas repeat it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pair(edits: Column, items: Column) -> Column:
    return F.struct(edits.cast("bigint").alias("edits"), items.cast("bigint").alias("items"))


def _short_char_counts(truth: Column, result: Column) -> Column:
    return let(F.struct(strip_ends(truth).alias("a"), strip_ends(result).alias("b")),
               lambda p: _pair(F.levenshtein(p["a"], p["b"]), F.length(p["a"])))


def _short_word_counts(truth: Column, result: Column) -> Column:
    def encode(side: Column, vocabulary: Column) -> Column:
        codes = F.transform(side, lambda w: F.substring(F.lit(_WORD_CODES), F.array_position(vocabulary, w), 1))
        return F.array_join(codes, "")

    return let(F.struct(words(truth).alias("a"), words(result).alias("b")), lambda p: let(
        F.array_distinct(F.concat(p["a"], p["b"])),
        lambda v: _pair(F.levenshtein(encode(p["a"], v), encode(p["b"], v)), F.size(p["a"]))))


def _by_length(truth: Column, result: Column, short, long) -> Column:
    """Struct of edits and truth items; short pairs in the JVM, long ones through Arrow."""
    small = F.length(truth) + F.length(result) <= NATIVE_CHARS
    return F.coalesce(F.when(small, short(truth, result)), F.when(~small, long(F.when(~small, truth), F.when(~small, result))))


def char_counts(truth: Column, result: Column) -> Column:
    """Character edits between two texts and characters of the truth, ends stripped."""
    return _by_length(truth, result, _short_char_counts, _char_counts_arrow)


def word_counts(truth: Column, result: Column) -> Column:
    """Word edits between two texts and words of the truth, after white-space normalization."""
    return _by_length(truth, result, _short_word_counts, _word_counts_arrow)


def char_edits(truth: Column, result: Column) -> Column:
    return char_counts(truth, result)["edits"]


def word_edits(truth: Column, result: Column) -> Column:
    return word_counts(truth, result)["edits"]


def _rate(counts: Column) -> Column:
    return let(counts, lambda c: F.try_divide(c["edits"].cast("double"), c["items"].cast("double")))


def cer(truth: Column, result: Column) -> Column:
    """Character error rate; null for an empty truth, may exceed 1."""
    return _rate(char_counts(truth, result))


def wer(truth: Column, result: Column) -> Column:
    """Word error rate; null for an empty truth, may exceed 1."""
    return _rate(word_counts(truth, result))


_RATES = T.ArrayType(T.StructType([T.StructField("wer", T.DoubleType()), T.StructField("cer", T.DoubleType())]))


def _rates_of(rows: list[tuple]) -> list:
    """Rates of a few truths, each with its results; the pairs of all are compared together."""
    found = [None if given is None else [{"wer": None, "cer": None} for _ in given] for _, given in rows]
    for name, items in (("wer", _normal_words), ("cer", str.strip)):
        places, pairs = [], []
        for (truth, given), rates in zip(rows, found):
            whole = items(truth) if truth is not None and given is not None else None
            for result, rate in zip(given, rates) if whole else ():
                if result is not None:
                    places.append(rate)
                    pairs.append((whole, items(result)))
        for rate, (whole, _), edits in zip(places, pairs, distances(pairs)):
            rate[name] = edits / len(whole)
    return found


@F.pandas_udf(_RATES)
def _all_rates_arrow(truth: pd.Series, results: pd.Series) -> pd.Series:
    found = []
    for rows in _stretches([*zip(truth, results)], lambda row: len(row[0] or "") * (1 + len(row[1] if row[1] is not None else ()))):
        found += _rates_of(rows)
    return pd.Series(found, dtype=object)


def all_rates(truth: Column, results: Column) -> Column:
    """Word and character error rates of several results of one truth, in order.

    The truth goes to the scorer once, however many results it has.
    """
    return _all_rates_arrow(truth, results)


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    known = set(a) & set(b)
    # Items of one side only are in no common sequence.
    a, b = [x for x in a if x in known], [x for x in b if x in known]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    positions: dict = {}
    for i, item in enumerate(a):
        positions.setdefault(item, []).append(i)
    cut, full = _match_cutter(positions, len(a)), (1 << len(a)) - 1
    # A zero bit for every step up of a column of the table.
    column, kept = full, {}
    room = max(256, _KEPT_BITS // len(a))
    for item in b:
        same = kept.get(item)
        if same is None:
            same = cut(item, 0, len(a))
            if len(kept) < room:
                kept[item] = same
        meet = column & same
        column = (column + meet | column - meet) & full
    return len(a) - column.bit_count()


def count_edits(truth: list, result: list) -> tuple[int, int, int, int]:
    """Hits, substitutions, deletions, insertions of a shortest alignment.

    Among the shortest alignments the one with the fewest substitutions is
    taken: an edit costs BASE and a substitution one more, so one cost carries
    both counts and no traceback has to be kept. Equal ends are hits in some
    best alignment and are cut off; the distance, found first, says how far
    alignments of that cost can stray from the diagonal.

    Often no such table is needed. With e edits there are at most e - |growth|
    substitutions; and as replacing each by a deletion and an insertion leaves a
    common subsequence, at least the difference between the distance without
    substitutions and e. Where both agree that is the number.
    """
    low, n = 0, min(len(truth), len(result))
    while low < n and truth[low] == result[low]:
        low += 1
    high = 0
    while high < n - low and truth[-1 - high] == result[-1 - high]:
        high += 1
    truth, result = truth[low:len(truth) - high], result[low:len(result) - high]
    codes: dict = {}
    t = np.array([codes.setdefault(w, len(codes)) for w in truth], dtype=np.int64)
    r = np.array([codes.setdefault(w, len(codes)) for w in result], dtype=np.int64)
    growth, base = len(r) - len(t), len(t) + len(r) + 1
    if not len(t) or not len(r):
        return low + high, 0, len(t), len(r)
    edits = edit_distance(t.tolist(), r.tolist())
    most = edits - abs(growth)
    if most == 0 or len(t) + len(r) - 2 * common_length(t.tolist(), r.tolist()) - edits == most:
        deletions = (edits - most - growth) // 2
        return low + high + len(t) - most - deletions, most, deletions, edits - most - deletions
    # Cells (i, j) with i - down <= j <= i + up.
    down, up = (edits - growth) // 2, (edits + growth) // 2
    width, far = down + up + 1, base * base
    place = np.arange(width)
    padded = np.full(len(r) + len(t) + 2 * width + 2, -1, dtype=np.int64)
    padded[width:width + len(r)] = r
    ramp = base * place
    # Row 0: j = place - down; one cell more, always far, stands behind the band.
    wide = np.full(width + 1, far, dtype=np.int64)
    row, above = wide[:width], wide[1:]
    row[:] = np.where((place >= down) & (place - down <= len(r)), base * (place - down), far)
    best, moved, same = np.empty(width, dtype=np.int64), np.empty(width, dtype=np.int64), np.empty(width, dtype=bool)
    for i, word in enumerate(t.tolist(), start=1):
        first = i - down
        np.equal(padded[first - 1 + width:first - 1 + 2 * width], word, out=same)
        np.multiply(same, -(base + 1), out=moved)
        moved += row
        moved += base + 1
        np.add(above, base, out=best)
        np.minimum(best, moved, out=best)
        if first <= 0:
            best[:-first] = far
            best[-first] = base * i
        if i + up > len(r):
            best[len(r) - first + 1:] = far
        best -= ramp
        np.minimum.accumulate(best, out=row)
        row += ramp
    edits, substitutions = divmod(int(row[len(r) - len(t) + down]), base)
    moved = edits - substitutions
    deletions = (moved - growth) // 2
    return low + high + len(t) - substitutions - deletions, substitutions, deletions, moved - deletions


_EDIT_STATS = T.StructType([
    T.StructField(name, T.LongType()) for name in ("hits", "substitutions", "deletions", "insertions")
])


# Lists of up to so many words are aligned many at a time: costs fit 16 bits.
_ALIGNED_WORDS, _EDIT_COST = 64, 256


def batch_count_edits(pairs: list[tuple[list, list]]) -> list[tuple[int, int, int, int]]:
    """``count_edits`` of many pairs of short lists: the rows of a table of costs for all pairs at once."""
    found: list = [None] * len(pairs)
    pairs = _numbered(pairs)
    order = sorted(range(len(pairs)), key=lambda i: len(pairs[i][0]), reverse=True)
    for start in range(0, len(order), BATCH_PAIRS):
        batch = order[start:start + BATCH_PAIRS]
        a, a_sizes = _padded([pairs[i][0] for i in batch])
        b, b_sizes = _padded([pairs[i][1] for i in batch])
        b = np.ascontiguousarray(b[:, :max(int(b_sizes.max()), 1)].T)
        ramp = (_EDIT_COST * np.arange(len(b) + 1, dtype=np.int16))[:, None]
        row = np.repeat(ramp, len(batch), axis=1)
        going = np.searchsorted(-a_sizes, -np.arange(int(a_sizes.max())), side="left")
        for i, k in enumerate(going.tolist()):
            old = row[:, :k]
            new = old + np.int16(_EDIT_COST)
            np.minimum(new[1:], old[:-1] + (b[:, :k] != a[:k, i]) * np.int16(_EDIT_COST + 1), out=new[1:])
            new -= ramp
            row[:, :k] = np.minimum.accumulate(new, axis=0) + ramp
        edits, substitutions = np.divmod(row[b_sizes, np.arange(len(batch))].astype(np.int64), _EDIT_COST)
        deletions = (edits - substitutions - b_sizes + a_sizes) // 2
        counts = (a_sizes - substitutions - deletions, substitutions, deletions, edits - substitutions - deletions)
        for i, row_of in zip(batch, zip(*(c.tolist() for c in counts))):
            found[i] = row_of
    return found


@F.pandas_udf(_EDIT_STATS)
def _edit_stats_arrow(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    found = []
    for rows in _stretches([*zip(a, b)], _both):
        pairs = [None if x is None or y is None else (_normal_words(x), _normal_words(y)) for x, y in rows]
        short = [p is not None and max(map(len, p)) <= _ALIGNED_WORDS for p in pairs]
        aligned = iter(batch_count_edits([p for p, s in zip(pairs, short) if s]))
        found += [(None,) * 4 if p is None else next(aligned) if s else count_edits(*p) for p, s in zip(pairs, short)]
    return pd.DataFrame(found, columns=_EDIT_STATS.names, dtype="Int64")


def edit_stats(truth: Column, result: Column) -> Column:
    """Struct of hits, substitutions, deletions and insertions on words."""
    return _edit_stats_arrow(truth, result)


def round2(value: Column) -> Column:
    return F.round(value, 2)
