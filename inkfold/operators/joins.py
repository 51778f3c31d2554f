"""Join helpers that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How many parts the rows of one key are dealt to.
SALTS = 32


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, spread: list, how: str = "inner",
                 salts: int = SALTS) -> DataFrame:
    """Attach a table holding few rows per key to a table holding many.

    The rows of a key are dealt to ``salts`` parts by a hash of the ``spread``
    columns and the small side is repeated once per part, so a hot key never
    lands in one task. No broadcast is forced: Spark broadcasts on its own when
    the measured size of the small side allows it.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    repeated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def truth_join(truth: DataFrame, result: DataFrame, key: str = "doc_id", missing_as_empty: bool = True) -> DataFrame:
    """Pair truth and result by key (never by listing order).

    A truth without a result is paired with empty texts, since an empty result
    may come as no row at all; without ``missing_as_empty`` it drops out.
    """
    if not missing_as_empty:
        return truth.join(result, key)
    texts = [f.name for f in result.schema if f.dataType.typeName() == "string" and f.name != key]
    return truth.join(result, key, "left").na.fill("", texts)


def unpaired_keys(truth: DataFrame, result: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys found on one side only, with the side they are missing from."""
    no_result = truth.join(result, key, "left_anti").select(key, F.lit("result").alias("missing"))
    no_truth = result.join(truth, key, "left_anti").select(key, F.lit("truth").alias("missing"))
    return no_result.unionByName(no_truth)


def record_pair_join(a: DataFrame, b: DataFrame, fields: list[str], key: str = "doc_id") -> DataFrame:
    """Records present in both sources; columns become ``<field>_a`` / ``<field>_b``."""
    left = a.select(key, *[F.col(f).alias(f"{f}_a") for f in fields])
    right = b.select(key, *[F.col(f).alias(f"{f}_b") for f in fields])
    return left.join(right, key)


def vector_lookup(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Attach the vector of each token's word; words without one drop out.

    A plain join: where a word is hot, Spark deals its tokens to several tasks and
    repeats that part of the vocabulary alone, as measured, so copies follow skew.
    """
    return tokens.join(vocabulary, "word")


def image_mask_join(pixels: DataFrame, masks: DataFrame) -> DataFrame:
    """Pixels of an image with the same pixels of its mask."""
    return pixels.join(masks, ["img_id", "y", "x"])


def pair_files(images: DataFrame, masks: DataFrame, suffix: str = "_gt") -> DataFrame:
    """Pair files ``k.*`` with masks ``k<suffix>.*`` by stem.

    Input columns: ``name``. Output has the number of files found on each side;
    a valid pair has exactly one image and one mask.
    """
    def stem(name: Column) -> Column:
        return F.regexp_replace(name, "\\.[^.]*$", "")

    left = images.where(~F.startswith("name", F.lit("."))).groupBy(stem(F.col("name")).alias("key")).agg(
        F.count("*").alias("n_images"), F.min("name").alias("image"))
    right = (masks.select(stem(F.col("name")).alias("stem"), "name")
             .where(F.endswith("stem", F.lit(suffix)))
             .groupBy(F.expr(f"left(stem, length(stem) - {len(suffix)})").alias("key"))
             .agg(F.count("*").alias("n_masks"), F.min("name").alias("mask")))
    paired = left.join(right, "key", "left").withColumn("n_masks", F.coalesce("n_masks", F.lit(0)))
    return paired.withColumn("valid", (F.col("n_images") == 1) & (F.col("n_masks") == 1))


def cross_scalar(rows: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Attach one global value, given as a one-row one-column table."""
    return rows.withColumn(name, one_row.scalar())
