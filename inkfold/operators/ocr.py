"""Scoring extracted text against truth, per document and per setting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions import text
from inkfold.operators.joins import join_per_key


def config_sweep(docs: DataFrame, settings: dict[str, Column], output: str = "et") -> DataFrame:
    """Every document under every setting: columns ``config`` and ``output`` are added.

    The settings are columns of one projection, so the documents are read once
    and no join is made.
    """
    variants = F.array(*[
        F.struct(F.lit(name).alias("config"), value.alias(output)) for name, value in settings.items()
    ])
    return docs.select("*", F.inline(variants))


def score_texts(pairs: DataFrame, truth: str = "gt", result: str = "et") -> DataFrame:
    """Add ``wer`` and ``cer`` per row.

    Scoring costs far more than reading, so texts that sit in few partitions
    are worth a ``repartition(n)`` first.
    """
    truth_col, result_col = F.col(truth), F.col(result)
    return (pairs.withColumn("wer", text.wer(truth_col, result_col))
            .withColumn("cer", text.cer(truth_col, result_col)))


def sweep_scores(docs: DataFrame, settings: dict[str, Column], truth: str = "gt", key: str = "doc_id") -> DataFrame:
    """``key, config, wer, cer`` of every document under every setting.

    The same rates as ``score_texts`` after ``config_sweep``, for long texts: the
    settings of a document are scored together, so its true text is handed over,
    stripped and split once.
    """
    scored = docs.select(key, text.all_rates(F.col(truth), F.array(*settings.values())).alias("_rates"))
    names = F.array(*[F.lit(name) for name in settings])
    rows = F.inline_outer(F.arrays_zip(names.alias("config"), F.col("_rates")))
    return scored.select(key, rows).select(key, "config", "_rates.wer", "_rates.cer")


def ocr_error_summary(scores: DataFrame, by: str = "config") -> DataFrame:
    """Mean of the per-document rates per setting, two decimals."""
    return scores.groupBy(F.col(by).alias("source")).agg(
        text.round2(F.avg("wer")).alias("wer"), text.round2(F.avg("cer")).alias("cer"))


def append_results(tables: list[DataFrame]) -> DataFrame:
    """Running result table: rows appended in order given, duplicates kept."""
    return reduce(lambda done, more: done.unionByName(more), tables)


def l2_normalized_rates(scores: DataFrame, columns: list[str], by: str | None = None,
                        key: str = "doc_id") -> DataFrame:
    """Each rate divided by the L2 norm of its column, over all rows or per setting ``by``.

    The scores are read twice; store them first where scoring is dear.
    """
    norms = [F.sqrt(F.sum(F.col(c) * F.col(c))).alias(f"_norm_{c}") for c in columns]
    if by:
        joined = join_per_key(scores, scores.groupBy(by).agg(*norms), by, [key])
    else:
        norm = scores.agg(F.struct(*norms)).scalar()
        joined = scores.withColumn("_norm", norm).select(
            "*", *[F.col(f"_norm._norm_{c}") for c in columns]).drop("_norm")
    for c in columns:
        joined = joined.withColumn(f"{c}_norm", F.try_divide(F.col(c), F.col(f"_norm_{c}")))
    return joined.drop(*[f"_norm_{c}" for c in columns])
