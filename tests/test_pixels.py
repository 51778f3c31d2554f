import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkfold import schemas
from inkfold.operators import masks, pages, pixels, scores
from inkfold.sources import files


def table(spark, images):
    rows = [(k, y, x, int(v)) for k, img in images.items() for y, line in enumerate(img) for x, v in enumerate(line)]
    return spark.createDataFrame(rows, schemas.PIXEL).orderBy(F.rand(4))


def grid(df, value, shape, img=0):
    out = [[None] * shape[1] for _ in range(shape[0])]
    for r in df.where(F.col("img_id") == img).collect():
        assert out[r["y"]][r["x"]] is None
        out[r["y"]][r["x"]] = r[value]
    return out


def near(img, y, x, k):
    h, w = len(img), len(img[0])
    return [(j, i) for j in range(max(0, y - k), min(h, y + k + 1)) for i in range(max(0, x - k), min(w, x + k + 1))]


def slow_contrast(img, k, wrap=True):
    out = []
    for y in range(len(img)):
        line = []
        for x in range(len(img[0])):
            around = [img[j][i] for j, i in near(img, y, x, k)]
            total = max(around) + min(around)
            value = np.float32((max(around) - min(around)) / ((total % 256 if wrap else total) + 0.001))
            line.append(min(value, np.float32(1)))
        out.append(line)
    return out


def slow_otsu(values):
    """Level by trying every split."""
    n, best, level = len(values), 0.0, 0
    for t in range(255):
        low, high = [v for v in values if v <= t], [v for v in values if v > t]
        if low and high:
            var = len(low) * len(high) / n / n * (sum(low) / len(low) - sum(high) / len(high)) ** 2
            if var > best * (1 + 1e-12):
                best, level = var, t
    return level


def slow_decide(img, e, k, n_min, mode):
    out = []
    for y in range(len(img)):
        line = []
        for x in range(len(img[0])):
            around = near(img, y, x, k)
            if mode == "reference":
                es, vs = [e[j][i] for j, i in around], [img[j][i] for j, i in around]
                es.remove(e[y][x])
                vs.remove(img[y][x])
                ws = [2 if a == 255 else 1 for a in es]
                n = es.count(255)
                mean = sum(v * w % 256 for v, w in zip(vs, ws)) / n if n else 0.0
                std = math.sqrt(sum(((v - mean) * w) ** 2 for v, w in zip(vs, ws)) / 2)
            else:
                vs = [img[j][i] for j, i in around if (j, i) != (y, x) and e[j][i] == 255]
                n = len(vs)
                mean = sum(vs) / n if n else 0.0
                std = math.sqrt(max(0.0, sum(v * v for v in vs) / n - mean * mean)) if n else 0.0
            line.append(0 if n >= n_min and img[y][x] <= mean + std / 2 else 255)
        out.append(line)
    return out


@pytest.fixture(scope="module")
def images():
    rng = random.Random(8)
    return {
        0: [[rng.randint(0, 255) for _ in range(13)] for _ in range(11)],
        1: [[rng.choice([20, 30, 200]) for _ in range(5)] for _ in range(9)],
        2: [[7] * 4 for _ in range(3)],
        3: [[9]],
    }


@pytest.mark.parametrize("window, mode", [(3, "reference"), (2, "reference"), (5, "reference"), (3, "paper")])
def test_su_steps_against_brute_force(spark, images, window, mode):
    k = window // 2
    df = table(spark, images)
    contrast = pixels.local_contrast(df, window, mode, tile=4).cache()
    result = pixels.su_binarize(df, window, 2, mode, tile=4).cache()
    wide = pixels.su_binarize(df, window, 2, mode).cache()
    rows = pixels.image_to_pixels(pages.su_binarize_images(pixels.pixels_to_image(df), window, 2, mode)).cache()
    for key, img in images.items():
        shape = (len(img), len(img[0]))
        want = slow_contrast(img, k, mode == "reference")
        assert np.allclose(grid(contrast, "c", shape, key), want, rtol=0, atol=0)
        levels = [[int(math.floor(np.float32(c * np.float32(255)))) for c in line] for line in want]
        level = slow_otsu([v for line in levels for v in line])
        e = [[255 if v > level else 0 for v in line] for line in levels]
        assert grid(result, "e", shape, key) == e
        assert grid(result, "b", shape, key) == slow_decide(img, e, k, 2, mode)
        assert grid(wide, "b", shape, key) == grid(result, "b", shape, key)
        assert grid(rows, "v", shape, key) == grid(result, "b", shape, key)


@pytest.mark.parametrize("window, mode", [(3, "reference"), (7, "paper")])
def test_strips_do_not_matter(monkeypatch, window, mode):
    image = np.random.default_rng(2).integers(0, 256, (40, 17), dtype=np.uint8)
    whole = pages.binarize(image, window // 2, 3, mode)
    monkeypatch.setattr(pages, "STRIP_PIXELS", 50)
    assert (pages.binarize(image, window // 2, 3, mode) == whole).all()


def test_contrast_wraps_in_one_byte(spark):
    df = table(spark, {0: [[200, 100]]})
    assert {r["c"] for r in pixels.local_contrast(df, 3).collect()} == {1.0}  # 100 / 44 capped
    paper = {round(r["c"], 4) for r in pixels.local_contrast(df, 3, "paper").collect()}
    assert paper == {round(100 / 300.001, 4)}


def test_modes_and_limits_are_checked(spark, images):
    df = table(spark, images)
    with pytest.raises(ValueError):
        pixels.local_contrast(df, 3, "other")
    with pytest.raises(ValueError):
        pixels.su_binarize(df, 3, 0)
    with pytest.raises(ValueError):
        pixels.mask_resize_nearest(df, 1.5)
    with pytest.raises(Exception, match="no pixel"):
        pixels.mask_resize_nearest(df, 0.2).collect()


@pytest.mark.parametrize("scale", [1.0, 0.75, 0.5, 0.34])
def test_resize_nearest(spark, images, scale):
    big = {k: v for k, v in images.items() if len(v) >= 3}
    found = pixels.mask_resize_nearest(table(spark, big), scale).cache()
    for key, img in big.items():
        h, w = len(img), len(img[0])
        nh, nw = int(scale * h), int(scale * w)
        want = [[img[(2 * y + 1) * h // (2 * nh)][(2 * x + 1) * w // (2 * nw)] for x in range(nw)] for y in range(nh)]
        assert grid(found, "v", (nh, nw), key) == want


def test_flip_twice_is_identity(spark, images):
    df = table(spark, images)
    yes = F.lit(True)
    once = pixels.pixel_flip(df, yes, yes, yes)
    assert grid(once, "v", (11, 13)) == [line[::-1] for line in images[0][::-1]]
    twice = pixels.pixel_flip(once, yes, yes, yes)
    assert sorted(map(tuple, twice.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_crop_clips_to_image(spark, images):
    boxes = spark.createDataFrame([(0, 0, 2, -3, 5, 4, 40), (0, 1, 2, 6, 6, 6, 9), (0, 2, 2, 3, 3, 9, 8)],
                                  "img_id bigint, det_no int, cls int, x1 int, y1 int, x2 int, y2 int")
    crops = pixels.crop_boxes(table(spark, images), boxes, tile=4).cache()
    assert grid(crops.where("det_no = 0"), "v", (6, 4)) == [line[0:4] for line in images[0][5:]]
    assert grid(crops.where("det_no = 2"), "v", (5, 6)) == [line[3:9] for line in images[0][3:8]]
    assert crops.where("det_no = 1").count() == 0


def test_far_boxes_list_few_tiles(spark, images):
    boxes = spark.createDataFrame([(0, 0, 2, 3, 3, 2_000_000_000, 2_000_000_000)],
                                  "img_id bigint, det_no int, cls int, x1 int, y1 int, x2 int, y2 int")
    crop = pixels.crop_boxes(table(spark, images), boxes, tile=4)
    h, w = len(images[0]), len(images[0][0])
    assert grid(crop, "v", (h - 3, w - 3)) == [line[3:] for line in images[0][3:]]


@pytest.mark.parametrize("gone", [(0, 0), (0, 1), (1, 1), "line"])
def test_gap_is_an_error(spark, gone):
    cells = [(7, y, x, 10 * y + x) for y in range(3) for x in range(2) if (y != 1 if gone == "line" else (y, x) != gone)]
    df = spark.createDataFrame(cells, "img_id bigint, y int, x int, v int")
    with pytest.raises(Exception, match="image 7"):
        pixels.pixels_to_image(df).collect()


def test_bytes_round_trip(spark):
    img = {5: [list(range(0, 128)), list(range(128, 256))]}
    image = pixels.pixels_to_image(table(spark, img))
    row = image.first()
    assert (row["height"], row["width"]) == (2, 128) and bytes(row["data"]) == bytes(range(256))
    assert grid(pixels.image_to_pixels(image), "v", (2, 128), 5) == img[5]


def test_scale_only_bright_images(spark):
    df = table(spark, {0: [[0, 1]], 1: [[0, 51]]})
    got = {(r["img_id"], r["x"]): r["value"] for r in pixels.pixel_scale(df).collect()}
    assert got == {(0, 0): 0.0, (0, 1): 1.0, (1, 0): 0.0, (1, 1): 0.2}


def png(path, rows, channels):
    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    raw = b"".join(b"\0" + bytes(v for px in row for v in (px if channels == 3 else [px])) for row in rows)
    head = struct.pack(">IIBBBBB", len(rows[0]), len(rows), 8, 2 if channels == 3 else 0, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_image_scan(spark, tmp_path):
    png(tmp_path / "img_4.png", [[0, 255, 7], [1, 2, 3]], 1)
    png(tmp_path / "0012_x.png", [[(255, 0, 0), (0, 255, 0)], [(0, 0, 255), (10, 20, 30)]], 3)
    (tmp_path / "img_9.png").write_bytes(b"no image")
    found = pixels.gray(files.image_scan(spark, str(tmp_path))).cache()
    assert grid(found, "v", (2, 3), 4) == [[0, 255, 7], [1, 2, 3]]
    assert grid(found, "v", (2, 2), 12) == [[76, 150], [29, 18]]
    assert found.select("img_id").distinct().count() == 2
    rows = pixels.image_to_pixels(pages.gray_images(files.image_scan(spark, str(tmp_path))))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, found.collect()))


# Scores and masks ---------------------------------------------------------


def pair_table(spark, gt, pred):
    rows = [(0, y, x, gt[y][x], pred[y][x]) for y in range(len(gt)) for x in range(len(gt[0]))]
    return spark.createDataFrame(rows, "img_id bigint, y int, x int, gt int, pred int")


def test_metrics_by_hand(spark):
    df = pair_table(spark, [[0, 0, 255, 255]], [[0, 255, 255, 0]])
    row = scores.binarization_metrics(df).first()
    assert (row["accuracy"], row["fm"], row["mcc"], row["nrm"]) == (50.0, 50.0, 0.0, 0.5)
    assert abs(row["psnr"] - 10 * math.log10(2)) < 1e-12
    perfect = scores.binarization_metrics(pair_table(spark, [[0, 255]], [[0, 255]])).first()
    assert perfect["psnr"] is None and perfect["fm"] == 100.0 and perfect["mcc"] == 1.0
    blank = scores.binarization_metrics(pair_table(spark, [[255, 255]], [[255, 255]])).first()
    assert blank["fm"] is None and blank["mcc"] is None and blank["accuracy"] == 100.0


def test_swapping_truth_and_result(spark, fx):
    m = fx.masks()
    a = {r["img_id"]: r for r in scores.binarization_metrics(m, "gt", "pred").collect()}
    b = {r["img_id"]: r for r in scores.binarization_metrics(m, "pred", "gt").collect()}
    same = lambda x, y: x == y or abs(x - y) < 1e-9
    assert all(same(a[k][c], b[k][c]) for k in a for c in ("accuracy", "fm", "mcc", "psnr"))
    assert any(a[k]["nrm"] != b[k]["nrm"] for k in a)


def test_drdm_by_hand(spark):
    gt = [[255] * 8 for _ in range(8)]
    gt[4][4] = 0
    pred = [[255] * 8 for _ in range(8)]  # the only ink pixel is missed
    assert scores.drdm(pair_table(spark, gt, pred)).first()["drdm"] == pytest.approx(0.0)
    pred = [list(line) for line in gt]
    pred[0][0] = 0  # one false ink pixel in the corner: 8 of 24 neighbours exist, all differ
    total = sum(1 / math.hypot(i, j) for i in range(-2, 3) for j in range(-2, 3) if i or j)
    want = sum(1 / math.hypot(i, j) for i in range(3) for j in range(3) if i or j) / total
    assert scores.drdm(pair_table(spark, gt, pred)).first()["drdm"] == pytest.approx(want)
    flat = [[255] * 8 for _ in range(8)]
    assert scores.drdm(pair_table(spark, flat, pred)).first()["drdm"] is None


def test_metric_modes(spark):
    df = spark.createDataFrame([("m", 2, "fm", 4.0), ("m", 1, "fm", 1.0), ("m", 1, "other", 9.0)],
                               "method string, img_id bigint, metric string, value double")
    assert scores.metric_means(df, ["method"]).first()["value"] == 2.5
    assert scores.metric_means(df, ["method"], "first").first()["value"] == 1.0
    assert scores.metric_means(df, ["method"]).count() == 1
    with pytest.raises(ValueError):
        scores.metric_means(df, ["method"], "median")


def test_dice_edges(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 1.0, 1.0)], "img_id bigint, p double, t double")
    got = {r["img_id"]: r["dice"] for r in masks.dice_per_mask(df, F.col("p"), F.col("t")).collect()}
    assert got[0] == 1.0 and got[1] == pytest.approx(1e-6 / (1 + 1e-6)) and got[2] == 1.0
    swapped = masks.dice_per_mask(df, F.col("t"), F.col("p")).collect()
    assert {r["img_id"]: r["dice"] for r in swapped} == got


def test_batch_mean_dice_without_a_full_batch(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7)], "img_id bigint, dice double")
    assert masks.batch_mean_dice(df, 5).first()[:] == (0.0, 0)
    assert masks.batch_mean_dice(df, 5, drop_last=False).first()[:] == (pytest.approx(0.6), 1)


def test_encode_decode_identity(spark):
    for values in ([0, 90, 255], [[0, 0, 0], [1, 2, 3], [9, 9, 9]]):
        kind = "array<int>" if isinstance(values[0], list) else "int"
        df = spark.createDataFrame([(v,) for v in values], f"raw {kind}")
        again = df.select("raw", masks.mask_decode(masks.mask_encode(F.col("raw"), values), values).alias("back"))
        assert again.where("raw <> back").count() == 0
    unknown = spark.sql("select 33 raw, array(1, 2, 4) rgb").select(
        masks.mask_encode(F.col("raw"), [0, 90]), masks.mask_encode(F.col("rgb"), [[0, 0, 0], [1, 2, 3]]))
    assert unknown.first()[:] == (0, 0)


def test_logits(spark):
    df = spark.sql("select array(1d, 3d, 3d) l, array(0d) one")
    pick = masks.logits_to_mask
    assert df.select(pick(F.col("l"), 3), pick(F.col("one"), 1), pick(F.col("one"), 1, 0.4)).first()[:] == (1, 0, 1)
