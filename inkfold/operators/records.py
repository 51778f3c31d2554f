"""Extraction records: building, parsing and comparing the five fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkfold import schemas
from inkfold.functions import text
from inkfold.functions.fixed_values import DECODE_ERROR, FIELDS, LABEL_TO_FIELD, OTHER_FIELD
from inkfold.operators.joins import record_pair_join

# Entities or turns per group of the first aggregation step.
CHUNK = 4096


def label_to_field(label: Column) -> Column:
    """Record field an entity label belongs to."""
    pairs = [F.lit(v) for item in LABEL_TO_FIELD.items() for v in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(OTHER_FIELD))


def entity_record(entities: DataFrame) -> DataFrame:
    """One record per document: texts of a field joined by a space, in document order.

    Entities are joined per stretch of a document first, so the sort of a very
    long document is shared by many tasks.
    """
    placed = entities.select(
        "doc_id", F.expr(f"start div {CHUNK}").alias("chunk"), "start", "text",
        label_to_field(F.col("label")).alias("field"))

    def joined(condition: Column, order: str, value: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(condition, F.struct(order, value))))
        return F.when(F.size(found) > 0, F.array_join(F.transform(found, lambda s: s[value]), " "))

    stretches = placed.groupBy("doc_id", "chunk").agg(
        *[joined(F.col("field") == f, "start", "text").alias(f) for f in FIELDS])
    return stretches.groupBy("doc_id").agg(
        *[joined(F.col(f).isNotNull(), "chunk", f).alias(f) for f in FIELDS])


def field_get_default(record: Column, field: str, default: str | None = None) -> Column:
    """A field of a string map, or the default when the key is absent."""
    found = F.map_contains_key(record, F.lit(field))
    return F.when(found, F.try_element_at(record, F.lit(field))).otherwise(F.lit(default))


def non_empty(value: Column) -> Column:
    return F.coalesce(value != "", F.lit(False))


def field_match(a: Column, b: Column) -> Column:
    """Equal values; two absent values count as a match."""
    return a.eqNullSafe(b)


def field_wer(a: Column, b: Column) -> Column:
    """Word error rate of two field values, null unless both are non-empty."""
    both = non_empty(a) & non_empty(b)
    return text.wer(F.when(both, a), F.when(both, b))


def compare_records(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    """Match flag, WER and non-empty flags per field for documents in both sources."""
    pairs = record_pair_join(a, b, FIELDS, key)
    columns = [F.col(key)]
    for f in FIELDS:
        left, right = F.col(f"{f}_a"), F.col(f"{f}_b")
        columns += [
            field_match(left, right).alias(f"{f}_match"),
            field_wer(left, right).alias(f"{f}_wer"),
            non_empty(left).alias(f"{f}_a_not_empty"),
            non_empty(right).alias(f"{f}_b_not_empty"),
        ]
    return pairs.select(*columns)


def _long(wide: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row of means -> one row per field."""
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"), *[F.col(f"{f}{c}").alias(f"{name}{c}") for c in columns])
        for f in FIELDS
    ])
    return wide.select(F.inline(rows))


def match_rates(comparison: DataFrame) -> DataFrame:
    """Share of matching documents per field, in percent."""
    means = comparison.agg(*[(F.avg(F.col(f"{f}_match").cast("int")) * 100).alias(f) for f in FIELDS])
    return _long(means, [""], "match_rate")


def non_empty_rates(comparison: DataFrame) -> DataFrame:
    """Share of non-empty values per field and source, in percent."""
    means = comparison.agg(*[
        (F.avg(F.col(f"{f}_{s}_not_empty").cast("int")) * 100).alias(f"{f}_{s}") for f in FIELDS for s in "ab"])
    return _long(means, ["_a", "_b"], "rate")


def field_wer_means(comparison: DataFrame) -> DataFrame:
    """Mean WER per field over the documents in which every field has one."""
    complete = comparison.na.drop("any", subset=[f"{f}_wer" for f in FIELDS])
    return _long(complete.agg(*[F.avg(f"{f}_wer").alias(f) for f in FIELDS]), [""], "mean_wer")


def json_repair(raw: Column) -> Column:
    """Drop the comma before a closing brace on its own line."""
    return F.replace(raw, F.lit(",\n}"), F.lit("\n}"))


# Spark reads single-quoted JSON unless told not to; a broken text lands in _bad.
_STRICT_JSON = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}


def valid_json(answer: Column) -> Column:
    """Whether the whole text is one JSON value.

    Spark's parsers stop after the first value. Wrapped once as an array and
    once as an object, no text with something left over passes both.
    """
    in_array = F.from_json(F.concat(F.lit("["), answer, F.lit("]")), "array<string>", _STRICT_JSON)
    in_object = F.from_json(F.concat(F.lit('{"a":'), answer, F.lit("}")), "a string, _bad string", _STRICT_JSON)
    return F.coalesce(in_array.isNotNull() & in_object["_bad"].isNull(), F.lit(False))


def json_repair_parse(answers: DataFrame, schema: T.StructType = schemas.RECORD, raw: str = "raw",
                      repair: bool = True) -> DataFrame:
    """Parse model answers; a broken one keeps null fields and an ``error`` text."""
    answer = json_repair(F.col(raw)) if repair else F.col(raw)
    parsed = answers.withColumn("_answer", answer)
    valid = valid_json(F.col("_answer"))
    record = F.from_json(F.when(valid, F.col("_answer")), schema, _STRICT_JSON)
    rest = [c for c in answers.columns if c != raw]
    return (parsed.withColumn("_record", record)
            .select(*rest, *[F.col(f"_record.{f.name}") for f in schema.fields],
                    F.when(~valid, DECODE_ERROR).alias("error")))


def answers_of_any_shape(answers: DataFrame, raw: str = "raw", repair: bool = True) -> DataFrame:
    """Model answers whatever their shape: the five fields, all other keys, and errors apart.

    Adds ``kind`` (object, array, other; null if broken), the fields as texts, ``extra`` (every other
    key of an object with its value as JSON), ``answer`` (the whole as VARIANT) and
    ``error``. A field that holds no text is given as JSON. Of a key that is
    there twice the answer counts as broken, as it cannot be kept whole.
    """
    text = json_repair(F.col(raw)) if repair else F.col(raw)
    parsed = answers.withColumn("_text", text)
    value = F.try_parse_json(F.when(valid_json(F.col("_text")), F.col("_text")))
    held = parsed.withColumn("answer", value)
    shape = F.schema_of_variant("answer")
    kind = F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(F.col("answer").isNotNull(), "other")
    keys = F.when(F.col("kind") == "object", F.col("answer").cast("map<string,variant>"))
    rest = [c for c in answers.columns if c != raw]

    def field(name: str) -> Column:
        own = F.element_at("_keys", F.lit(name))
        return F.when(F.schema_of_variant(own) == "STRING", own.cast("string")).when(
            ~F.is_variant_null(own), F.to_json(own)).alias(name)
    extra = F.transform_values(F.map_filter("_keys", lambda k, _: ~k.isin(FIELDS)), lambda _, v: F.to_json(v))
    return held.withColumn("kind", kind).withColumn("_keys", keys).select(
        *rest, "kind", *[field(f) for f in FIELDS], extra.alias("extra"), "answer",
        F.when(F.col("answer").isNull(), DECODE_ERROR).alias("error"))


def build_messages(user_text: Column, prompt: str) -> Column:
    """System prompt and user text as a message array."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(prompt)), message("user", user_text))


def conversation_fold(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Turns in order as a message array: one row per conversation, however long.

    Turns are sorted and gathered per stretch first, so the sort of a very long
    conversation is shared by many tasks; then its stretches are joined.
    """
    message = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    stretches = turns.groupBy("conv_id", F.expr(f"turn div {chunk}").alias("part")).agg(
        F.array_sort(F.collect_list(message)).alias("turns"))
    whole = stretches.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "turns"))).alias("parts"))
    in_order = F.flatten(F.transform("parts", lambda p: p["turns"]))
    return whole.select("conv_id", F.transform(in_order, lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
