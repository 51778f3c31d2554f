"""Rule-based entity spans on caption tokens.

A caption is one row and its tokens are an array of that row, so matching
neither shuffles nor groups: every rule is a filter over token positions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold import schemas
from inkfold.functions import text
from inkfold.functions.fixed_values import (
    FIELDS,
    FILM_WORDS,
    MONTHS,
    PERSON_PATTERN,
    PHOTO_CREDIT,
    YEAR_PATTERN,
)
from inkfold.operators.records import label_to_field

# Captions with up to this many spans are resolved in the JVM.
NATIVE_SPANS = 64
# Token positions of one bin of the interval join.
BIN = 1024


def _is_ascii(word: Column) -> Column:
    return F.length(word) == F.octet_length(word)


def month_year(word: Column, following: Column) -> Column:
    return F.array_contains(F.array(*[F.lit(m) for m in MONTHS]), word) & following.rlike(YEAR_PATTERN)


def year(word: Column) -> Column:
    return word.rlike(YEAR_PATTERN)


def credited_person(word: Column, following: Column) -> Column:
    return (word == PHOTO_CREDIT) & following.rlike(PERSON_PATTERN)


def film_start(word: Column, following: Column) -> Column:
    """A film word that at least one ASCII token follows."""
    return F.lower(word).isin(FILM_WORDS) & _is_ascii(following)


def _spans(tokens: Column, other: Column) -> Column:
    size = F.size(tokens)
    # sequence() counts down for an empty array, hence the slice.
    positions = F.slice(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), 1, size)

    def found(rule, end, label: str) -> Column:
        hits = F.filter(positions, lambda i: F.coalesce(rule(i), F.lit(False)))
        return F.transform(hits, lambda i: F.struct(
            i.cast("int").alias("start"), end(i).cast("int").alias("end"), F.lit(label).alias("label")))

    def at(i: Column) -> Column:
        return F.get(tokens, i)

    def film_end(i: Column) -> Column:
        stop = F.array_position(F.slice(other, i + 2, F.greatest(size, F.lit(1))), True)
        return F.when(stop > 0, i + stop).otherwise(size)

    return F.concat(
        found(lambda i: month_year(at(i), at(i + 1)), lambda i: i + 2, "DATE"),
        found(lambda i: year(at(i)), lambda i: i + 1, "DATE"),
        found(lambda i: credited_person(at(i), at(i + 1)), lambda i: i + 2, "PERSON"),
        found(lambda i: film_start(at(i), at(i + 1)), film_end, "FILM"),
    )


def token_pattern_match(captions: DataFrame, column: str = "text") -> DataFrame:
    """Add ``tokens`` and ``spans`` (start, end exclusive, label), overlaps kept."""
    return (captions.withColumn("tokens", text.tokens(F.col(column)))
            .withColumn("_other", F.transform("tokens", lambda w: ~_is_ascii(w)))
            .withColumn("spans", _spans(F.col("tokens"), F.col("_other")))
            .drop("_other"))


def take_longest(spans) -> list[tuple[int, int, str]]:
    """Longest span first, then by start, end and label; a span touching a taken token is dropped.

    An empty span has no token: it is dropped only strictly inside a kept one.
    """
    taken: set[int] = set()
    inside: set[int] = set()
    kept = []
    for start, end, label in sorted(spans, key=lambda s: (s[0] - s[1], s[0], s[1], s[2])):
        if start in inside if start == end else start in taken or end - 1 in taken:
            continue
        taken.update(range(start, end))
        inside.update(range(start + 1, end))
        kept.append((start, end, label))
    return sorted(kept)


@F.pandas_udf(T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("label", T.StringType()),
])))
def _take_longest_arrow(spans: pd.Series) -> pd.Series:
    return spans.map(lambda rows: None if rows is None else [
        dict(zip(("start", "end", "label"), span))
        for span in take_longest((r["start"], r["end"], r["label"]) for r in rows)
    ])


def longest_match_resolve(df: DataFrame, column: str = "spans") -> DataFrame:
    """Resolve overlaps in a span array; spans come out in token order.

    A few spans are folded in the JVM; arrays with more go to an Arrow UDF,
    whose cost does not grow with the square of their number. Both take spans in
    the same order and hold empty spans alike.
    """
    ordered = F.array_sort(F.transform(column, lambda s: F.struct(
        (s["start"] - s["end"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        s["label"].alias("label"))))

    def is_free(kept: Column, s: Column) -> Column:
        return ~F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))

    folded = F.aggregate(
        ordered, F.array().cast(f"array<{schemas.SPAN}>"),
        lambda kept, s: F.when(is_free(kept, s), F.array_append(
            kept, F.struct(s["start"], s["end"], s["label"]).cast(schemas.SPAN))).otherwise(kept))
    few = F.size(column) <= NATIVE_SPANS
    return df.withColumn(column, F.coalesce(
        F.array_sort(F.when(few, folded)), _take_longest_arrow(F.when(~few, F.col(column)))))


def span_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Span arrays -> one row per span.

    The outer form keeps Spark from adding a "size > 0" filter that would
    compute the spans a second time.
    """
    return df.select(*keep, F.inline_outer("spans")).where("start is not null")


def spans_to_entities(df: DataFrame) -> DataFrame:
    """Span arrays -> one row per entity with its text."""
    return span_rows(df, "doc_id", "tokens").select(
        "doc_id", "start", "label",
        F.array_join(F.slice("tokens", F.col("start") + 1, F.col("end") - F.col("start")), " ").alias("text"))


def caption_records(captions: DataFrame, column: str = "text") -> DataFrame:
    """Captions -> five-field records, without a shuffle."""
    resolved = longest_match_resolve(token_pattern_match(captions, column))

    def field(name: str) -> Column:
        own = F.filter("spans", lambda s: label_to_field(s["label"]) == name)
        texts = F.transform(own, lambda s: F.array_join(
            F.slice(F.col("tokens"), s["start"] + 1, s["end"] - s["start"]), " "))
        return F.when(F.size(own) > 0, F.array_join(texts, " ")).alias(name)

    return resolved.select("doc_id", *[field(f) for f in FIELDS])


def entity_tokens(resolved: DataFrame) -> DataFrame:
    """Tokens inside each entity span, with its label: ``doc_id, pos, word, label``.

    Tokens and spans of a caption sit in one row, so nothing is joined.
    """
    spans = span_rows(resolved, "doc_id", "tokens").where(F.col("end") > F.col("start"))
    places = F.sequence(F.col("start"), F.col("end") - 1)
    words = F.slice("tokens", F.col("start") + 1, F.col("end") - F.col("start"))
    return spans.select("doc_id", "label", F.inline_outer(F.arrays_zip(places.alias("pos"), words.alias("word")))).select(
        "doc_id", "pos", "word", "label")


def span_bins(spans: DataFrame) -> DataFrame:
    """``doc_id, label, _start, _end, _bin``: spans, once per bin they touch; empty ones touch none."""
    bins = F.sequence(F.floor(F.col("start") / BIN), F.floor((F.col("end") - 1) / BIN))
    return spans.where(F.col("end") > F.col("start")).select(
        "doc_id", "label", F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(bins).alias("_bin"))


def entity_token_join(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Tokens of one table inside the entity spans of another, with the label.

    An interval join by bins: a span is listed once per ``BIN`` positions it touches,
    a token has one bin, and within a bin its position decides. No document is a
    group of its own, and a span costs its length divided by ``BIN``. Where both come from
    one caption row, ``entity_tokens`` needs no join.
    """
    named = tokens.withColumn("_bin", F.floor(F.col("pos") / BIN))
    inside = (F.col("pos") >= F.col("_start")) & (F.col("pos") < F.col("_end"))
    return named.join(span_bins(spans), ["doc_id", "_bin"]).where(inside).select(*tokens.columns, "label")


def vectors_by_label(entity_tokens: DataFrame) -> DataFrame:
    """Long form of the vectors per entity label: one row per token with a vector."""
    return entity_tokens.where(F.col("vec").isNotNull()).select("label", "word", "vec")


def label_counts(entity_vectors: DataFrame) -> DataFrame:
    return entity_vectors.groupBy("label").agg(
        F.count("*").alias("n_vectors"), F.count_distinct("word").alias("n_words"))
