"""Words, keys and stored tables shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.sources.files import work_folder

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def group_key(column: str | Column) -> Column:
    """A string that is never null and sorts by code point, null last."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("a"), column.cast("string")), F.lit("b"))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each lengthened until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new shared folder and read back: cuts lineage, survives lost executors."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def dealt_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join on a bigint column; both sides are shuffled, none is broadcast however small Spark takes it for.

    Spark counts a stored table as its compressed files, and what ``mapInArrow`` or a
    generator makes of it as no more rows, so a side of any size could pass for one that
    the driver may collect. Of a key with very many rows Spark deals the rows anew, but
    only where the shuffle is made for the join: the key's bits are turned over, so that no
    shuffle of an aggregation below is taken for it.
    """
    def turned(df: DataFrame) -> DataFrame:
        return df.select(F.bitwise_not(on).alias(on), *[c for c in df.columns if c != on])
    return turned(turned(left).join(turned(right).hint("merge"), on))


def tasks(df: DataFrame) -> int:
    """Parts for work that costs far more than its shuffle."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
