"""Token patterns given as data, compiled to a token automaton.

A list of patterns is what users change first, so it is an argument:

    [{"label": "DATE", "pattern": [{"TEXT": {"IN": ["Mai", "Juni"]}}, {"TEXT": {"REGEX": "^[0-9]{4}$"}}]},
     {"label": "FILM", "pattern": [{"LOWER": "film"}, {"IS_ASCII": True, "OP": "+"}]},
     {"label": "LOC", "pattern": "Neue Donau"}]

Each step of a pattern asks for attributes of one token: ``TEXT`` (or ``ORTH``) and
``LOWER``, equal to a value or by ``REGEX``, ``IN`` and ``NOT_IN``; ``LENGTH`` by value or by
``==``, ``!=``, ``>=``, ``<=``, ``>`` and ``<``; ``IS_ASCII``, ``IS_DIGIT``, ``IS_ALPHA``, ``IS_LOWER``,
``IS_UPPER`` and ``IS_TITLE``. ``OP`` says how often: once, ``?``, ``+``, ``*``, or ``!`` for one token that does
not fit. A step without attributes fits every token. A pattern that is a text stands
for its tokens.

Every token is first told by one number, the bits of the attributes it has. The
automaton then reads these numbers from the last to the first and knows, for every
state, the furthest end that can be reached from here; so all matches of a caption,
each the longest from its start, cost one pass however quantifiers follow each other.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold import schemas
from inkfold.functions import text
from inkfold.functions.fixed_values import (
    FILM_WORDS,
    MONTHS_ENGLISH,
    MONTHS_ENGLISH_SHORT,
    MONTHS_GERMAN,
    MONTHS_GERMAN_SHORT,
    PERSON_PATTERN,
    PHOTO_CREDIT,
    YEAR_PATTERN,
)
from inkfold.functions.text import let

# Attributes told apart by the bits of one number; longer lists are matched in several rounds.
BITS = 62
# Captions with up to this many tokens are matched in the JVM.
NATIVE_TOKENS = 64
_SPANS = f"array<{schemas.SPAN}>"

_YEAR = {"TEXT": {"REGEX": YEAR_PATTERN}}
# The caption rules as a list.
CAPTION_PATTERNS = [
    *({"label": "DATE", "pattern": [{"TEXT": {"IN": months}}, _YEAR]}
      for months in (MONTHS_ENGLISH, MONTHS_GERMAN, MONTHS_GERMAN_SHORT, MONTHS_ENGLISH_SHORT)),
    {"label": "DATE", "pattern": [_YEAR]},
    {"label": "PERSON", "pattern": [{"TEXT": PHOTO_CREDIT}, {"TEXT": {"REGEX": PERSON_PATTERN}}]},
    *({"label": "FILM", "pattern": [{"LOWER": word}, {"IS_ASCII": True, "OP": "+"}]} for word in FILM_WORDS),
]


class Step(NamedTuple):
    """One step: the bit of its attributes (-1: any token), whether it must not fit, and how often it is taken."""

    bit: int
    negated: bool
    often: str  # "1", "?" or "*"


class Pattern(NamedTuple):
    label: str
    steps: tuple[Step, ...]


class Automaton(NamedTuple):
    attributes: list[dict]
    patterns: list[Pattern]


def _attribute(token: Column, key: str, wanted) -> Column:
    if key in ("TEXT", "ORTH", "LOWER"):
        value = F.lower(token) if key == "LOWER" else token
        if isinstance(wanted, str):
            return value == wanted
        tests = {"REGEX": lambda w: value.rlike(w), "IN": lambda w: value.isin(list(w)), "NOT_IN": lambda w: ~value.isin(list(w))}
    elif key == "LENGTH":
        value = F.length(token)
        if isinstance(wanted, int):
            return value == wanted
        tests = {"==": value.__eq__, "!=": value.__ne__, ">=": value.__ge__, "<=": value.__le__, ">": value.__gt__, "<": value.__lt__,
                 "IN": lambda w: value.isin(list(w))}
    else:
        flags = {
            "IS_ASCII": F.length(token) == F.octet_length(token), "IS_DIGIT": token.rlike("^\\p{Nd}+$"), "IS_ALPHA": token.rlike("^\\p{L}+$"),
            "IS_LOWER": (token == F.lower(token)) & token.rlike("\\p{L}"), "IS_UPPER": (token == F.upper(token)) & token.rlike("\\p{L}"),
            "IS_TITLE": token.rlike("^[^\\p{L}]*\\p{Lu}[^\\p{Lu}]*$")}
        if key not in flags or not isinstance(wanted, bool):
            raise ValueError(f"unknown attribute {key}: {wanted!r}")
        return flags[key] if wanted else ~flags[key]
    if not isinstance(wanted, dict) or not wanted or not set(wanted) <= set(tests):
        raise ValueError(f"unknown test of {key}: {wanted!r}")
    out = F.lit(True)
    for name, value_wanted in wanted.items():
        out = out & tests[name](value_wanted)
    return out


def fits(token: Column, attributes: dict) -> Column:
    """Whether a token has all the attributes."""
    out = F.lit(True)
    for key, wanted in attributes.items():
        out = out & _attribute(token, key, wanted)
    return F.coalesce(out, F.lit(False))


def compile_patterns(patterns: list[dict]) -> list[Automaton]:
    """Automata for a list of patterns; equal attributes share a bit, and one automaton has at most ``BITS``."""
    out: list[Automaton] = []
    bits: dict[str, int] = {}
    for entry in patterns:
        given = entry["pattern"]
        steps = [{"TEXT": t} for t in given.split()] if isinstance(given, str) else given
        if not steps:
            raise ValueError("a pattern needs a step")
        asked = [{k: v for k, v in s.items() if k != "OP"} for s in steps]
        names = [json.dumps(a, sort_keys=True) for a in asked]
        new = {n for a, n in zip(asked, names) if a and n not in bits}
        if not out or len(bits) + len(new) > BITS:
            bits = {}
            out.append(Automaton([], []))
        compiled: list[Step] = []
        for step, attributes, name in zip(steps, asked, names):
            if attributes and name not in bits:
                if len(bits) == BITS:
                    raise ValueError(f"one pattern may ask for {BITS} attributes")
                bits[name] = len(bits)
                out[-1].attributes.append(attributes)
            bit, often = bits[name] if attributes else -1, step.get("OP", "1")
            if often not in ("1", "?", "+", "*", "!"):
                raise ValueError(f"unknown OP {often!r}")
            compiled += {"1": [Step(bit, False, "1")], "!": [Step(bit, True, "1")], "?": [Step(bit, False, "?")],
                         "*": [Step(bit, False, "*")], "+": [Step(bit, False, "1"), Step(bit, False, "*")]}[often]
        out[-1].patterns.append(Pattern(entry["label"], tuple(compiled)))
    return out


def token_bits(tokens: Column, automaton: Automaton) -> Column:
    """One number per token: the bits of the attributes it has."""
    def number(token: Column) -> Column:
        total = F.lit(0).cast("bigint")
        for i, attributes in enumerate(automaton.attributes):
            total = total + F.when(fits(token, attributes), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        return total
    return F.transform(tokens, number)


def _native_spans(bits: Column, pattern: Pattern) -> Column:
    """Spans of one pattern, folded over the numbers from the last to the first."""
    steps, schema = pattern.steps, f"struct<at:int,ends:array<int>,spans:{_SPANS}>"

    def taken(step: Step, number: Column) -> Column:
        if step.bit < 0:
            return F.lit(not step.negated)
        has = number.bitwiseAND(F.lit(1 << step.bit).cast("bigint")) != 0
        return ~has if step.negated else has

    def at_end(size: Column) -> Column:
        # Behind the last token only steps that may be left out lead on.
        optional = [all(s.often != "1" for s in steps[j:]) for j in range(len(steps) + 1)]
        ends = F.array(*[size if o else F.lit(-1) for o in optional])
        return F.struct(size.alias("at"), ends.alias("ends"), F.array().cast(_SPANS).alias("spans")).cast(schema)

    def read(state: Column, number: Column) -> Column:
        at = state["at"] - 1
        ends = [at]
        for j in range(len(steps) - 1, -1, -1):
            step = steps[j]
            on = F.when(taken(step, number), F.get(state["ends"], F.lit(j if step.often == "*" else j + 1))).otherwise(F.lit(-1))
            ends.insert(0, on if step.often == "1" else F.greatest(on, ends[0]))

        def with_ends(found: Column) -> Column:
            end = F.get(found, F.lit(0))
            span = F.struct(at.alias("start"), end.alias("end"), F.lit(pattern.label).alias("label")).cast(schemas.SPAN)
            spans = F.when(end > at, F.array_append(state["spans"], span)).otherwise(state["spans"])
            return F.struct(at.alias("at"), found.alias("ends"), spans.alias("spans")).cast(schema)
        return let(F.array(*ends), with_ends)

    return F.aggregate(F.reverse(bits), at_end(F.size(bits)), read, lambda state: state["spans"])


def longest_ends(bits: list[int], steps: tuple[Step, ...]) -> list[int]:
    """For every start the furthest end of a match, -1 without one."""
    m, n = len(steps), len(bits)
    masks = [1 << s.bit if s.bit >= 0 else 0 for s in steps]
    behind = [n if all(s.often != "1" for s in steps[j:]) else -1 for j in range(m + 1)]
    out = [-1] * n
    for at in range(n - 1, -1, -1):
        number, here = bits[at], [at] * (m + 1)
        for j in range(m - 1, -1, -1):
            step = steps[j]
            fit = (step.bit < 0 or bool(number & masks[j])) != step.negated
            end = behind[j if step.often == "*" else j + 1] if fit else -1
            here[j] = end if step.often == "1" else max(end, here[j + 1])
        behind, out[at] = here, here[0]
    return out


def _arrow_spans(bits: Column, patterns: list[Pattern]) -> Column:
    @F.pandas_udf(_SPANS)
    def run(rows: pd.Series) -> pd.Series:
        def spans(row) -> list[dict] | None:
            if row is None:
                return None
            numbers = row.tolist()
            return [{"start": start, "end": end, "label": p.label}
                    for p in patterns for start, end in enumerate(longest_ends(numbers, p.steps)) if end > start]
        return rows.map(spans)
    # Marked so that Spark keeps it in a step of its own: merged with another Arrow function
    # that reads its result, it would not be planned.
    return run.asNondeterministic()(bits)


def pattern_spans(tokens: Column, bits: list[Column], automata: list[Automaton]) -> Column:
    """Spans (start, end exclusive, label) of all patterns, each the longest from its start; equal ones once."""
    few = F.size(tokens) <= NATIVE_TOKENS
    found = []
    for numbers, automaton in zip(bits, automata):
        native = F.when(few, F.concat(*[_native_spans(numbers, p) for p in automaton.patterns]))
        found.append(F.coalesce(native, _arrow_spans(F.when(~few, numbers), automaton.patterns)))
    # Sorted, equal spans are neighbours, so they go in one pass.
    return let(F.array_sort(F.concat(*found)), lambda spans: F.filter(spans, lambda s, i: (i == 0) | (s != F.get(spans, i - 1))))


def token_pattern_list(captions: DataFrame, patterns: list[dict] | None = None, column: str = "text") -> DataFrame:
    """Add ``tokens`` and ``spans`` (start, end exclusive, label) of a list of patterns, overlaps kept.

    Without a list the caption rules hold. A null text has null spans, an empty one none. Captions are matched in their
    row, without a shuffle: short ones by built-in functions, longer ones in an Arrow function
    whose cost is the tokens times the steps.
    """
    automata = compile_patterns(CAPTION_PATTERNS if patterns is None else patterns)
    if not automata:
        return captions.withColumn("tokens", text.tokens(F.col(column))).withColumn("spans", F.array().cast(_SPANS))
    names = [f"_bits_{i}" for i in range(len(automata))]
    told = captions.withColumn("tokens", text.tokens(F.col(column))).withColumns(
        {n: token_bits(F.col("tokens"), a) for n, a in zip(names, automata)})
    return told.withColumn("spans", pattern_spans(F.col("tokens"), [F.col(n) for n in names], automata)).drop(*names)
