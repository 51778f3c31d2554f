"""Numbering, splitting, batching and sorting without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.sources.files import work_folder

def path_sort(df: DataFrame, path: str = "path") -> DataFrame:
    """Ascending by path string, so "10" sorts before "2"."""
    return df.orderBy(path)


def value_sort(df: DataFrame, value: str) -> DataFrame:
    return df.select(value).distinct().orderBy(value)


# Bits of a row's place that count rows inside its partition.
_INSIDE = 33


def global_row_number(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """1-based position of each row in the order of ``order`` over the whole table.

    Rows are dealt to key ranges (Spark samples the keys; the session's shuffle
    partitions say how many ranges, so they grow with the cluster), sorted inside
    their range and stored in the shared folder: the input is read twice, for the
    sample and for the rows. A stored row's place is its range and its number
    there; ranges are shifted by the rows of those before. ``order`` should
    identify a row, so that equal keys neither pile up in a range nor leave the
    order open.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    folder = work_folder(spark, "row-number")
    ranged.withColumn("_place", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    # One row per range passes through the window and the broadcast.
    counts = rows.groupBy(F.shiftright("_place", _INSIDE).alias("_range")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << _INSIDE) - 1)) + 1
    placed = rows.withColumn("_range", F.shiftright("_place", _INSIDE)).join(F.broadcast(shifts), "_range")
    return placed.select(*df.columns, (F.col("_shift") + inside).alias(name))


def sequence_index(df: DataFrame, path: str = "path") -> DataFrame:
    """Number files 1, 2, ... in path order and name them ``img_<n>``."""
    numbered = global_row_number(df, [path])
    return numbered.withColumn("name", F.concat(F.lit("img_"), F.col("idx")))


def first_detection(boxes: DataFrame, wanted: int) -> DataFrame:
    """First box of the wanted class per image; images without one drop out.

    A minimum, not a window: it combines before the shuffle.
    """
    rest = [c for c in boxes.columns if c not in ("img_id", "cls")]
    first = F.min(F.struct("det_no", *[c for c in rest if c != "det_no"])).alias("_first")
    return (boxes.where(F.col("cls") == wanted).groupBy("img_id", "cls").agg(first)
            .select("img_id", "cls", *[F.col(f"_first.{c}") for c in rest]))


def exact_split(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Mark exactly ``int(n * fraction)`` rows "val" and the rest "train".

    Rows are ordered by a seeded hash of the key. Counting 65,536 hash buckets
    finds the one bucket the cut falls into; only its rows are ranked.
    """
    hashed = (df.withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))))
              .withColumn("_bucket", F.substring("_hash", 1, 4)))
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # At most 65,536 rows pass through this window and the broadcast.
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_n").over(Window.partitionBy())
    cuts = counts.select(
        "_bucket", before.alias("_before"), (before + F.col("_n")).alias("_upto"),
        F.floor(total.cast("double") * fraction).alias("_cut"))
    placed = hashed.join(F.broadcast(cuts), "_bucket")
    whole = placed.where((F.col("_upto") <= F.col("_cut")) | (F.col("_before") >= F.col("_cut")))
    whole = whole.withColumn("split", F.when(F.col("_upto") <= F.col("_cut"), "val").otherwise("train"))
    torn = placed.where((F.col("_upto") > F.col("_cut")) & (F.col("_before") < F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    torn = torn.withColumn(
        "split", F.when(F.col("_before") + rank <= F.col("_cut"), "val").otherwise("train"))
    return whole.unionByName(torn).select(*df.columns, "split")


def batching(df: DataFrame, key: str, size: int, drop_last: bool = False,
             shuffle_seed: int | None = None) -> DataFrame:
    """Consecutive batches of ``size`` rows in key order, or in a seeded shuffle of it."""
    order = [key]
    if shuffle_seed is not None:
        df = df.withColumn("_shuffle", F.xxhash64(F.col(key), F.lit(shuffle_seed)))
        order = ["_shuffle", key]
    numbered = global_row_number(df, order, "_idx").drop("_shuffle")
    batched = numbered.withColumn("batch", F.expr(f"(_idx - 1) div {size}"))
    if drop_last:
        rows = df.agg(F.count("*")).scalar()
        batched = batched.where((F.col("batch") + 1) * size <= rows)
    return batched.drop("_idx")


def word_frequency(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("word").agg(F.count("*").alias("n"))


def top_words(tokens: DataFrame, k: int = 200) -> DataFrame:
    """The k most frequent words, ties by word."""
    return word_frequency(tokens).orderBy(F.desc("n"), "word").limit(k)
