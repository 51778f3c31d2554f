"""Image rows give what pixel tables give, with a join on the image id as their only exchange."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkfold.operators import masks, pages, pixels, scores
from test_pixels import grid, table

RNG = random.Random(9)
SIZES = {0: (1, 1), 1: (9, 17), 2: (24, 8), 3: (40, 3), 4: (16, 16)}
IMAGES = {k: [[RNG.randint(0, 255) for _ in range(w)] for _ in range(h)] for k, (h, w) in SIZES.items()}
TRUTH = {k: [[0 if v < 120 else 255 for v in line] for line in img] for k, img in IMAGES.items()}
RESULT = {k: [[0 if v < 90 + 7 * k else 255 for v in line] for line in img] for k, img in IMAGES.items()}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Stored image rows of the three sets."""
    out = {}
    for name, images in {"image": IMAGES, "truth": TRUTH, "result": RESULT}.items():
        folder = str(tmp_path_factory.mktemp("pages") / name)
        pixels.pixels_to_image(table(spark, images)).write.parquet(folder)
        out[name] = spark.read.parquet(folder)
    return out


def cells(df):
    return sorted((r["img_id"], r["y"], r["x"], r["v"]) for r in pixels.image_to_pixels(df).collect())


def scored(df):
    return {tuple(r)[0] if "cls" not in df.columns else tuple(r)[:2]: tuple(r)[1:] for r in df.collect()}


def both(spark):
    truth = table(spark, TRUTH).withColumnRenamed("v", "gt")
    return truth.join(table(spark, RESULT).withColumnRenamed("v", "pred"), ["img_id", "y", "x"])


def exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]


def test_row_by_row_forms(spark, rows):
    coins = F.col("img_id") % 2 == 0, F.col("img_id") > 2
    flipped = pages.flip_images(rows["image"], *coins)
    want = pixels.pixel_flip(table(spark, IMAGES), horizontal=coins[0], vertical=coins[1], augment=F.lit(True))
    assert cells(flipped) == sorted((r["img_id"], r["y"], r["x"], r["v"]) for r in want.collect())
    small = pages.resize_images_nearest(rows["image"].where("img_id > 0"), 0.4)
    want = pixels.mask_resize_nearest(table(spark, {k: v for k, v in IMAGES.items() if k}), 0.4)
    assert cells(small) == sorted((r["img_id"], r["y"], r["x"], r["v"]) for r in want.collect())
    want = pixels.otsu_threshold(table(spark, IMAGES))
    assert cells(pages.otsu_images(rows["image"])) == sorted((r["img_id"], r["y"], r["x"], r["e"]) for r in want.collect())
    for df in (flipped, small, pages.otsu_images(rows["image"]), pages.scale_images(rows["image"])):
        assert not exchanges(df)
    with pytest.raises(Exception, match="image 0"):
        pages.resize_images_nearest(rows["image"], 0.4).collect()


def test_scores_of_pairs(spark, rows):
    pairs, pixel_pairs = pages.pair_images(rows["truth"], rows["result"]), both(spark)
    found = {"metrics": pages.binarization_metrics_images(pairs), "drdm": pages.drdm_images(pairs)}
    want = {"metrics": scores.binarization_metrics(pixel_pairs), "drdm": scores.drdm(pixel_pairs)}
    for name in found:
        a, b = scored(found[name]), scored(want[name])
        assert a.keys() == b.keys()
        for k in a:
            assert a[k] == pytest.approx(b[k], nan_ok=True) if None not in a[k] else a[k] == b[k]
        assert all("img_id" in x and "y#" not in x for x in exchanges(found[name])) and len(exchanges(found[name])) <= 2
    ones = {k: [[v // 255 for v in line] for line in img] for k, img in TRUTH.items()}, {k: [[v // 100 for v in line] for line in img] for k, img in IMAGES.items()}
    cls = [table(spark, x) for x in ones]
    dice = pages.dice_images(pages.pair_images(*[pixels.pixels_to_image(x) for x in cls]), 3, skip_background=False)
    joined = cls[0].withColumnRenamed("v", "t").join(cls[1].withColumnRenamed("v", "p"), ["img_id", "y", "x"])
    a, b = scored(dice), scored(masks.dice_multiclass(joined, "p", "t", 3, skip_background=False))
    assert a.keys() == b.keys() and all(a[k][-1] == pytest.approx(b[k][-1]) for k in a)


def test_pairs_that_do_not_fit(spark, rows):
    cut = pages.resize_images_nearest(rows["result"].where("img_id > 0"), 0.5)
    checks = {r["img_id"]: (r["bad_size"], r["bad_range"]) for r in
              pages.mask_checks_images(pages.pair_images(rows["truth"], cut, "left"), 256).collect()}
    assert checks == {k: (True, False) for k in SIZES}
    assert pages.mask_checks_images(pages.pair_images(rows["truth"], rows["result"]), 256).count() == 0
    with pytest.raises(Exception, match="differ in size"):
        pages.drdm_images(pages.pair_images(rows["truth"], cut)).collect()


def test_page_larger_than_a_tile(spark):
    """A page that crosses tile and strip borders, in all forms."""
    page = {0: [[(7 * y * x + 13 * y + x * x) % 256 for x in range(30)] for y in range(270)]}
    df = table(spark, page)
    plain = grid(pixels.su_binarize(df, 3, 3, tile=512), "b", (270, 30))
    assert grid(pixels.su_binarize(df, 3, 3), "b", (270, 30)) == plain
    strips = pages.su_binarize_images(pixels.pixels_to_image(df), 3, 3, strip_pixels=700)
    assert grid(pixels.image_to_pixels(strips), "v", (270, 30)) == plain
    assert np.array(plain).min() == 0
