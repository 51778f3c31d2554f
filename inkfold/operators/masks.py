"""Masks: class indexes, logits, checks and Dice scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.fixed_values import DICE_EPSILON
from inkfold.operators.ranking import batching


def distinct_mask_values(pixels: DataFrame, value: Column) -> DataFrame:
    """Distinct raw values over all masks, sorted; a value may be a number or an array (r, g, b)."""
    return pixels.select(value.alias("value")).distinct().orderBy("value")


def concat_unique(masks: list[DataFrame]) -> DataFrame:
    """Distinct values of several mask tables together."""
    first, *rest = masks
    for more in rest:
        first = first.unionByName(more)
    return first.distinct()


def mask_encode(raw: Column, mask_values: list) -> Column:
    """Raw mask value -> class index; an unknown value is class 0, the last equal entry wins."""
    index = F.lit(0)
    for i, value in enumerate(mask_values):
        literal = F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else F.lit(value)
        index = F.when(raw == literal, i).otherwise(index)
    return index


def mask_decode(cls: Column, mask_values: list) -> Column:
    """Class index -> raw value; an unmapped index is 0. Values [0, 1] give a boolean."""
    if list(mask_values) == [0, 1]:
        return F.coalesce(cls == 1, F.lit(False))
    triples = isinstance(mask_values[0], (list, tuple))
    literals = [F.array(*[F.lit(v) for v in value]) if triples else F.lit(value) for value in mask_values]
    empty = F.array(*[F.lit(0) for _ in mask_values[0]]) if triples else F.lit(0)
    known = (cls >= 0) & (cls < len(mask_values))
    return F.when(known, F.get(F.array(*literals), cls)).otherwise(empty)


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def logits_to_mask(logits: Column, classes: int, threshold: float = 0.5) -> Column:
    """Index of the largest logit (the first on a tie); with one class, sigmoid above the threshold."""
    if classes == 1:
        return (sigmoid(F.get(logits, F.lit(0))) > threshold).cast("int")
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def mask_checks(pairs: DataFrame, cls: str, n_classes: int) -> DataFrame:
    """Images whose mask breaks a rule: class out of range, or a pixel missing on one side.

    ``pairs`` is the full outer join of image and mask pixels with flags
    ``in_image`` and ``in_mask``.
    """
    facts = pairs.groupBy("img_id").agg(
        F.min(cls).alias("low"), F.max(cls).alias("high"),
        F.count_if("in_image").alias("image_pixels"), F.count_if("in_mask").alias("mask_pixels"),
        F.count_if(F.col("in_image") & F.col("in_mask")).alias("shared"))
    bad_range = (F.col("low") < 0) | (F.col("high") >= n_classes)
    bad_size = (F.col("image_pixels") != F.col("shared")) | (F.col("mask_pixels") != F.col("shared"))
    return (facts.withColumn("bad_range", F.coalesce(bad_range, F.lit(False))).withColumn("bad_size", bad_size)
            .where("bad_range or bad_size"))


def _dice(overlap: Column, total: Column) -> Column:
    """Dice from twice the overlap and the sum of both sides; two empty sides give 1."""
    return (overlap + DICE_EPSILON) / (F.when(total == 0, overlap).otherwise(total) + DICE_EPSILON)


def _sums(pred: Column, truth: Column) -> tuple[Column, Column]:
    overlap = 2 * F.sum(pred.cast("double") * truth.cast("double"))
    return overlap, F.sum(pred.cast("double")) + F.sum(truth.cast("double"))


def dice_per_mask(masks: DataFrame, pred: Column, truth: Column) -> DataFrame:
    """Dice per image for soft or 0/1 columns."""
    return masks.groupBy("img_id").agg(_dice(*_sums(pred, truth)).alias("dice"))


def dice_batch(masks: DataFrame, pred: Column, truth: Column) -> DataFrame:
    """One Dice over all pixels together."""
    return masks.agg(_dice(*_sums(pred, truth)).alias("dice"))


def dice_multiclass(masks: DataFrame, pred: str, truth: str, n_classes: int,
                    skip_background: bool = True) -> DataFrame:
    """Dice per image and class from class indexes.

    Sums are wide, one set per class, so no pixel is repeated per class.
    """
    classes = range(1 if skip_background else 0, n_classes)
    sums = masks.groupBy("img_id").agg(*[
        F.struct(F.lit(c).alias("cls"), _dice(*_sums(
            (F.col(pred) == c).cast("int"), (F.col(truth) == c).cast("int"))).alias("dice")).alias(f"_{c}")
        for c in classes])
    return sums.select("img_id", F.inline(F.array(*[F.col(f"_{c}") for c in classes])))


def dice_loss(masks: DataFrame, pred: Column, truth: Column) -> DataFrame:
    return dice_batch(masks, pred, truth).select((1 - F.col("dice")).alias("loss"))


def dice_loss_multiclass(pixels: DataFrame, logits: str, target: str) -> DataFrame:
    """1 - Dice of softmax probabilities against one-hot targets, all classes in one sum.

    Probabilities of a pixel and its one-hot row both sum to 1, so only the
    probability of the target class is needed.
    """
    top = F.array_max(logits)
    powers = F.transform(logits, lambda z: F.exp(z - top))
    chosen = F.get(powers, F.col(target)) / F.aggregate(powers, F.lit(0.0), lambda s, p: s + p)
    return pixels.agg((1 - _dice(2 * F.sum(chosen), 2.0 * F.count("*"))).alias("loss"))


def dice_bce_loss(pixels: DataFrame, logit: Column, target: Column) -> DataFrame:
    """Half the mean binary cross entropy on logits plus half of 1 - smoothed Dice."""
    z, t = logit.cast("double"), target.cast("double")
    entropy = F.avg(F.greatest(z, F.lit(0.0)) - z * t + F.log1p(F.exp(-F.abs(z))))
    p = sigmoid(z)
    score = (2 * F.sum(p * t) + DICE_EPSILON) / (F.sum(p) + F.sum(t) + DICE_EPSILON)
    return pixels.agg((0.5 * entropy + 0.5 * (1 - score)).alias("loss"))


def batch_mean_dice(per_image: DataFrame, batch_size: int, drop_last: bool = True) -> DataFrame:
    """Mean over full batches of the mean Dice in each batch; 0 when there is none.

    ``per_image`` has ``img_id`` and ``dice`` (several rows per image are fine
    for classes: they are averaged first, each image having as many).
    """
    images = per_image.groupBy("img_id").agg(F.avg("dice").alias("dice"))
    batches = batching(images, "img_id", batch_size, drop_last).groupBy("batch").agg(F.avg("dice").alias("dice"))
    return batches.agg(F.coalesce(F.avg("dice"), F.lit(0.0)).alias("dice"), F.count("*").alias("n_batches"))
