"""Image operators on whole image rows (img_id, height, width, data), without a pixel table.

Same results as the pixel forms for images that fit one row: bytes stay bytes
inside Arrow batches, neighbourhoods are worked on in strips of lines, and an
image meets its mask in a join on the image id alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.operators import masks as pixel_masks
from inkfold.operators import scores
from inkfold.operators.pixels import _check_mode

# Pixels a strip of lines holds at most (one line at least).
STRIP_PIXELS = 1 << 20


def _strips(height: int, width: int, margin: int, pixels: int | None = None):
    """(first, last) lines of each strip and the same with the margin around it."""
    lines = max(1, (pixels or STRIP_PIXELS) // max(width, 1))
    for first in range(0, height, lines):
        last = min(height, first + lines)
        yield first, last, max(0, first - margin), min(height, last + margin)


def _sweep(a: np.ndarray, k: int, axis: int, pick) -> np.ndarray:
    """``pick`` (maximum or minimum) over 2k + 1 neighbours along an axis, cut at the border."""
    out = a.copy()
    size = a.shape[axis]
    for step in range(1, min(k, size - 1) + 1):
        low = [slice(None)] * 2
        high = [slice(None)] * 2
        low[axis], high[axis] = slice(0, size - step), slice(step, size)
        low, high = tuple(low), tuple(high)
        pick(out[low], a[high], out=out[low])
        pick(out[high], a[low], out=out[high])
    return out


def contrast_levels(image: np.ndarray, k: int, mode: str, strip_pixels: int | None = None) -> np.ndarray:
    """Local contrast of each pixel as a level from 0 to 255."""
    levels = np.empty(image.shape, dtype=np.uint8)
    for first, last, top, bottom in _strips(*image.shape, k, strip_pixels):
        part = image[top:bottom]
        high = _sweep(_sweep(part, k, 1, np.maximum), k, 0, np.maximum)[first - top:last - top].astype(np.int32)
        low = _sweep(_sweep(part, k, 1, np.minimum), k, 0, np.minimum)[first - top:last - top].astype(np.int32)
        total = (high + low) % 256 if mode == "reference" else high + low
        contrast = np.minimum(((high - low) / (total + 0.001)).astype(np.float32), np.float32(1))
        levels[first:last] = np.floor(contrast * np.float32(255))
    return levels


def otsu_level(values: np.ndarray) -> int:
    counts = np.bincount(values.ravel(), minlength=256).astype(np.float64)
    below, weighted = counts.cumsum(), (counts * np.arange(256)).cumsum()
    above = below[-1] - below
    lean = below[-1] * weighted - below * weighted[-1]
    split = np.minimum(below, above) / below[-1] >= 1.1920929e-07
    variance = np.divide(lean * lean, below * above, out=np.zeros(256), where=split & (counts > 0))
    return int(variance.argmax())


def _box(a: np.ndarray, k: int) -> np.ndarray:
    """Sum over the window of half-width k, cut at the border."""
    sums = np.zeros((a.shape[0] + 1, a.shape[1] + 1), dtype=np.int64)
    sums[1:, 1:] = a.cumsum(axis=0, dtype=np.int64).cumsum(axis=1)
    y, x = np.arange(a.shape[0]), np.arange(a.shape[1])
    y0, y1 = np.maximum(y - k, 0)[:, None], np.minimum(y + k + 1, a.shape[0])[:, None]
    x0, x1 = np.maximum(x - k, 0)[None], np.minimum(x + k + 1, a.shape[1])[None]
    return sums[y1, x1] - sums[y0, x1] - sums[y1, x0] + sums[y0, x0]


def _paper_stats(v: np.ndarray, e: np.ndarray, k: int):
    parts = [e.astype(np.int64), e * v.astype(np.int64), e * v.astype(np.int64) ** 2]
    n, s, q = (_box(p, k) - p for p in parts)
    safe = np.maximum(n, 1).astype(np.float64)
    return n, s / safe, np.sqrt((n * q - s * s) / (safe * safe))


def _reference_stats(v: np.ndarray, e: np.ndarray, k: int):
    """Two value streams per pixel in window order, each losing its first value equal
    to the centre. They run at most one value apart, so one value waits per pixel."""
    height, width = v.shape
    wide_v, wide_e = np.pad(v.astype(np.int32), k), np.pad(e, k)
    inside = np.pad(np.ones(v.shape, dtype=bool), k)
    e_gone, v_gone = np.zeros(v.shape, dtype=bool), np.zeros(v.shape, dtype=bool)
    e_waits, v_waits = e_gone.copy(), e_gone.copy()
    e_held, v_held = e_gone.copy(), np.zeros(v.shape, dtype=np.int32)
    n, s, w0, w1, w2 = (np.zeros(v.shape, dtype=np.int64) for _ in range(5))
    for dy in range(2 * k + 1):
        for dx in range(2 * k + 1):
            cell = np.s_[dy:dy + height, dx:dx + width]
            here, cell_v, cell_e = inside[cell], wide_v[cell], wide_e[cell]
            drop_e = here & ~e_gone & (cell_e == e)
            drop_v = here & ~v_gone & (cell_v == v)
            e_gone |= drop_e
            v_gone |= drop_v
            e_comes, v_comes = here & ~drop_e, here & ~drop_v
            pair = (e_waits | e_comes) & (v_waits | v_comes)
            weight = np.where(np.where(e_waits, e_held, cell_e), 2, 1)
            value = np.where(v_waits, v_held, cell_v)
            square = np.where(pair, weight * weight, 0)
            s += np.where(pair, value * weight % 256, 0)
            w0 += square
            w1 += square * value
            w2 += square * value * value
            n += e_comes & cell_e
            # The newcomer waits when an older one was paired, or when it has no partner.
            e_held, v_held = np.where(e_comes, cell_e, e_held), np.where(v_comes, cell_v, v_held)
            e_waits = np.where(pair, e_waits & e_comes, e_waits | e_comes)
            v_waits = np.where(pair, v_waits & v_comes, v_waits | v_comes)
    mean = s / np.maximum(n, 1)
    mean[n == 0] = 0.0
    return n, mean, np.sqrt(np.maximum(w2 - 2 * mean * w1 + mean * mean * w0, 0) / 2)


def binarize(image: np.ndarray, k: int, n_min: int, mode: str, strip_pixels: int | None = None) -> np.ndarray:
    levels = contrast_levels(image, k, mode, strip_pixels)
    high = levels > otsu_level(levels)
    stats = _paper_stats if mode == "paper" else _reference_stats
    out = np.empty(image.shape, dtype=np.uint8)
    for first, last, top, bottom in _strips(*image.shape, k, strip_pixels):
        own = slice(first - top, last - top)
        n, mean, std = (part[own] for part in stats(image[top:bottom], high[top:bottom], k))
        ink = (n >= n_min) & (image[first:last] <= mean + std / 2)
        out[first:last] = np.where(ink, 0, 255)
    return out


def gray_images(images: DataFrame) -> DataFrame:
    """Rows of Spark's ``image`` source -> gray image rows, as ``pixels.gray`` without the pixel table."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = []
            for r in batch.itertuples(index=False):
                cells = np.frombuffer(r.data, dtype=np.uint8).reshape(-1, r.nChannels)
                if r.nChannels > 1:
                    blue, green, red = (cells[:, c].astype(np.float64) for c in range(3))
                    cells = np.floor(0.299 * red + 0.587 * green + 0.114 * blue + 0.5).astype(np.uint8)
                data.append(cells.tobytes())
            yield batch.drop(columns="nChannels").assign(data=data)

    readable = images.where("image.height > 0").select(
        "img_id", "image.height", "image.width", "image.nChannels", "image.data")
    return readable.mapInPandas(run, "img_id bigint, height int, width int, data binary")


def su_binarize_images(images: DataFrame, window_size: int, n_min: int, mode: str = "reference",
                       strip_pixels: int | None = None) -> DataFrame:
    """Image rows (img_id, height, width, data) -> the same with binary data (0 ink, 255 paper)."""
    _check_mode(mode)
    if n_min < 1:
        raise ValueError("n_min must be at least 1")
    k = window_size // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [
                binarize(np.frombuffer(r.data, dtype=np.uint8).reshape(r.height, r.width), k, n_min, mode, strip_pixels).tobytes()
                for r in batch.itertuples(index=False)
            ]
            yield batch.assign(data=data)

    return images.select("img_id", "height", "width", "data").mapInPandas(
        run, "img_id bigint, height int, width int, data binary")


# Bytes of one image ---------------------------------------------------------

_IMAGE = "img_id bigint, height int, width int, data binary"


def _matrix(row, column: str = "data") -> np.ndarray:
    return np.frombuffer(getattr(row, column), dtype=np.uint8).reshape(row.height, row.width)


def _changed(images: DataFrame, change, *facts: str) -> DataFrame:
    """Every image with ``change(matrix, row)`` in its place; ``facts`` are more columns the row has."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            new = [np.ascontiguousarray(change(_matrix(r), r), dtype=np.uint8) for r in batch.itertuples(index=False)]
            yield pd.DataFrame({"img_id": batch["img_id"], "height": [m.shape[0] for m in new], "width": [m.shape[1] for m in new],
                                "data": [m.tobytes() for m in new]})
    return images.select("img_id", "height", "width", "data", *facts).mapInPandas(run, _IMAGE)


def scale_images(images: DataFrame) -> DataFrame:
    """Adds ``scale``: 1/255 where some pixel is above 1, else 1. One number per image, bytes stay bytes."""
    @F.pandas_udf("boolean")
    def bright(data: pd.Series) -> pd.Series:
        return data.map(lambda d: np.frombuffer(d, dtype=np.uint8).max(initial=0) > 1)
    return images.withColumn("scale", F.when(bright("data"), 1 / F.lit(255.0)).otherwise(1.0))


def flip_images(images: DataFrame, across: Column, down: Column) -> DataFrame:
    """Mirror each image by its two coins; the same coins keep image and mask in step."""
    return _changed(images.withColumn("across", across).withColumn("down", down),
                    lambda m, r: m[::-1 if r.down else 1, ::-1 if r.across else 1], "across", "down")


def resize_images_nearest(images: DataFrame, scale: float) -> DataFrame:
    """Shrink to ``int(scale * size)``; target t reads source ``floor((t + 0.5) * size / new)``."""
    if not 0 < scale <= 1:
        raise ValueError("scale must be above 0 and at most 1")

    def shrink(m: np.ndarray, row) -> np.ndarray:
        places = []
        for size in m.shape:
            new = int(np.floor(size * scale))
            if not new:
                raise ValueError(f"scale is too small, image {row.img_id} would have no pixel")
            places.append((2 * np.arange(new) + 1) * size // (2 * new))
        return m[np.ix_(*places)]
    return _changed(images, shrink)


def otsu_images(images: DataFrame) -> DataFrame:
    """255 above the image's Otsu level, else 0."""
    return _changed(images, lambda m, r: np.where(m > otsu_level(m), 255, 0))


# An image and its mask ------------------------------------------------------


def pair_images(images: DataFrame, masks: DataFrame, how: str = "inner") -> DataFrame:
    """Image and mask of one id in one row: ``height, width, data`` and ``mask_height, mask_width, mask``."""
    other = masks.select("img_id", F.col("height").alias("mask_height"), F.col("width").alias("mask_width"), F.col("data").alias("mask"))
    return images.select("img_id", "height", "width", "data").join(other, "img_id", how)


def mask_checks_images(pairs: DataFrame, n_classes: int) -> DataFrame:
    """Pairs that break a rule: a class out of range, or sizes that differ (a missing side has no size)."""
    @F.pandas_udf("int")
    def highest(mask: pd.Series) -> pd.Series:
        return mask.map(lambda d: None if d is None else int(np.frombuffer(d, dtype=np.uint8).max(initial=0))).astype("Int32")
    same = F.col("height").eqNullSafe(F.col("mask_height")) & F.col("width").eqNullSafe(F.col("mask_width"))
    checked = pairs.select("img_id", highest("mask").alias("high"), (~same).alias("bad_size"))
    bad_range = F.coalesce(F.col("high") >= n_classes, F.lit(False))
    return checked.withColumn("bad_range", bad_range).where("bad_range or bad_size")


def _per_pair(pairs: DataFrame, measure, schema: str) -> DataFrame:
    """``measure(truth, result)`` of each pair (image: truth, mask: result) as columns after ``img_id``.

    Sizes that differ are an error.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if (r.height, r.width) != (r.mask_height, r.mask_width):
                    raise ValueError(f"image {r.img_id} and its mask differ in size")
                rows.append((r.img_id, *measure(_matrix(r), _matrix(r, "mask"))))
            yield pd.DataFrame(rows, columns=["img_id", *[c.split()[0] for c in schema.split(", ")]])
    return pairs.mapInPandas(run, f"img_id bigint, {schema}")


def binarization_metrics_images(pairs: DataFrame) -> DataFrame:
    """Accuracy, F-measure, MCC, PSNR and NRM per pair; counted in the batch, the formulas are those of the pixel form."""
    def counts(truth: np.ndarray, result: np.ndarray):
        t, r = truth == 0, result == 0
        both, n_t, n_r = int((t & r).sum()), int(t.sum()), int(r.sum())
        return float(both), float(n_r - both), float(n_t - both), float(t.size - n_t - n_r + both)
    return scores.metrics_of_counts(_per_pair(pairs, counts, "tp double, fp double, fn double, tn double"), ["img_id"])


def _distortion(truth: np.ndarray, result: np.ndarray) -> float:
    """Sum over wrong pixels of the weights of neighbours whose truth differs from the result there."""
    y, x = np.nonzero(truth != result)
    total = 0.0
    for dy, dx, weight in scores._drd_weights():
        ny, nx = y + dy, x + dx
        inside = (ny >= 0) & (nx >= 0) & (ny < truth.shape[0]) & (nx < truth.shape[1])
        total += weight * int((truth[ny[inside], nx[inside]] != result[y[inside], x[inside]]).sum())
    return total


def _mixed_blocks(truth: np.ndarray, side: int) -> int:
    """Blocks holding more than one value; those cut by the border count too."""
    rows, columns = (np.arange(0, size, side) for size in truth.shape)
    if not rows.size or not columns.size:
        return 0
    def reduced(pick) -> np.ndarray:
        return pick.reduceat(pick.reduceat(truth, rows, axis=0), columns, axis=1)
    return int((reduced(np.minimum) != reduced(np.maximum)).sum())


def drdm_images(pairs: DataFrame) -> DataFrame:
    """Distance-reciprocal distortion per pair, as ``scores.drdm``."""
    found = _per_pair(pairs, lambda t, r: (_distortion(t, r), _mixed_blocks(t, scores.BLOCK)), "drd double, blocks bigint")
    return found.select("img_id", F.try_divide("drd", "blocks").alias("drdm"))


def dice_images(pairs: DataFrame, n_classes: int, skip_background: bool = True) -> DataFrame:
    """Dice per pair and class from class indexes (image: truth, mask: result)."""
    classes = range(1 if skip_background else 0, n_classes)

    def sums(truth: np.ndarray, result: np.ndarray):
        t, r = (np.bincount(m.ravel(), minlength=256) for m in (truth, result))
        both = np.bincount(truth[truth == result], minlength=256)
        return [int(both[c]) for c in classes], [int(t[c] + r[c]) for c in classes]
    found = _per_pair(pairs, sums, "both array<bigint>, total array<bigint>")
    numbers = F.array(*[F.lit(c) for c in classes])
    rows = found.select("img_id", F.inline(F.arrays_zip(numbers.alias("cls"), "both", "total")))
    return rows.select("img_id", "cls", pixel_masks._dice(2 * F.col("both"), F.col("total")).alias("dice"))
