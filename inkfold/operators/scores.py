"""Scoring binarized images against truth; ink is 0, paper is 255."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.fixed_values import METRIC_LABELS

METRICS = list(METRIC_LABELS)
# Side of the truth blocks counted by DRDM.
BLOCK = 8


def binarization_metrics(masks: DataFrame, truth: str = "gt", result: str = "pred", by: list[str] | None = None) -> DataFrame:
    """Accuracy, F-measure, MCC, PSNR and NRM per image; a zero denominator gives null."""
    t, r = F.col(truth) == 0, F.col(result) == 0
    counts = masks.groupBy(*(by or []), "img_id").agg(
        F.count_if(t & r).cast("double").alias("tp"), F.count_if(~t & r).cast("double").alias("fp"),
        F.count_if(t & ~r).cast("double").alias("fn"), F.count_if(~t & ~r).cast("double").alias("tn"))
    return metrics_of_counts(counts, [*(by or []), "img_id"])


def metrics_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The five metrics from the counts of right and wrong ink and paper pixels."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    recall, precision = F.try_divide(tp, tp + fn), F.try_divide(tp, tp + fp)
    return counts.select(
        *keys,
        (100 * (tp + tn) / n).alias("accuracy"),
        F.try_divide(200 * precision * recall, precision + recall).alias("fm"),
        F.try_divide(tp * tn - fp * fn, F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)).alias("mcc"),
        F.when(fp + fn > 0, 10 * F.log10(F.try_divide(n, fp + fn))).alias("psnr"),
        ((F.try_divide(fn, fn + tp) + F.try_divide(fp, fp + tn)) / 2).alias("nrm"))


def _drd_weights() -> list[tuple[int, int, float]]:
    """Reciprocal distances of the 5 x 5 neighbourhood without its centre, summing to 1."""
    raw = [(i, j, 1 / math.hypot(i, j)) for i in range(-2, 3) for j in range(-2, 3) if i or j]
    total = sum(w for _, _, w in raw)
    return [(i, j, w / total) for i, j, w in raw]


def drdm(masks: DataFrame, truth: str = "gt", result: str = "pred") -> DataFrame:
    """Distance-reciprocal distortion per image over its non-uniform 8 x 8 truth blocks.

    Only wrong pixels look at their neighbours. Neighbours outside the image
    do not count; blocks cut by the border are blocks. No non-uniform block
    gives null.
    """
    weights = F.array(*[
        F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx"), F.lit(w).alias("weight")) for i, j, w in _drd_weights()])
    wrong = (masks.where(F.col(truth) != F.col(result))
             .select("img_id", "y", "x", F.col(result).alias("_got"), F.inline(weights))
             .select("img_id", (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x"), "_got", "weight")
             .where("y >= 0 and x >= 0"))
    near = wrong.join(masks.select("img_id", "y", "x", truth), ["img_id", "y", "x"])
    distortion = near.where(F.col(truth) != F.col("_got")).groupBy("img_id").agg(F.sum("weight").alias("_drd"))
    blocks = masks.groupBy("img_id", F.expr(f"y div {BLOCK}").alias("_by"), F.expr(f"x div {BLOCK}").alias("_bx")).agg(
        (F.min(truth) != F.max(truth)).alias("_mixed"))
    mixed = blocks.groupBy("img_id").agg(F.count_if("_mixed").alias("_blocks"))
    return mixed.join(distortion, "img_id", "left").select(
        "img_id", F.try_divide(F.coalesce("_drd", F.lit(0.0)), F.col("_blocks")).alias("drdm"))


def long_metrics(wide: DataFrame, keys: list[str]) -> DataFrame:
    """One row per image and metric."""
    present = [m for m in METRICS if m in wide.columns]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in present])
    return wide.select(*keys, F.inline(rows))


def metric_means(values: DataFrame, by: list[str], mode: str = "mean") -> DataFrame:
    """Mean of each known metric over images, two decimals; mode "first" takes the first image only."""
    if mode not in ("mean", "first"):
        raise ValueError(f"unknown mode {mode!r}")
    value = F.avg("value") if mode == "mean" else F.min_by("value", "img_id")
    return (values.where(F.col("metric").isin(METRICS)).groupBy(*by, "metric")
            .agg(F.round(value, 2).alias("value")))


def display_names(metric: Column) -> Column:
    pairs = [F.lit(v) for item in METRIC_LABELS.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), metric)


def metric_pivot(means: DataFrame, methods: list[str]) -> DataFrame:
    """Rows are metrics, columns are methods."""
    return means.groupBy("metric").pivot("method", methods).agg(F.first("value"))
