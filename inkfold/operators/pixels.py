"""Image operators on pixel tables (img_id, y, x, v).

Neighbourhood operators deal pixels to square tiles with a margin, so the unit
of work is a tile and never an image. Window functions inside a tile share the
tile's one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.operators.joins import join_per_key

TILE = 256
_CORNER = ["img_id", "ty", "tx"]


def _value_rows(images: DataFrame, values: Column) -> DataFrame:
    # The outer form keeps Spark from adding a "size > 0" filter that would
    # compute the values a second time.
    exploded = images.select("img_id", "width", F.posexplode_outer(values).alias("pos", "v")).where("pos is not null")
    return exploded.select("img_id", F.expr("cast(pos div width as int)").alias("y"),
                           (F.col("pos") % F.col("width")).alias("x"), "v")


def image_to_pixels(images: DataFrame) -> DataFrame:
    """Gray image rows -> one row per pixel."""
    # Latin-1 maps each byte to the character of the same number.
    values = F.transform(F.split(F.decode("data", "ISO-8859-1"), ""), lambda c: F.ascii(c))
    return _value_rows(images, values)


def pixels_to_image(pixels: DataFrame) -> DataFrame:
    """Pixel rows -> image rows, assembled line by line first.

    Every pixel must be there once: a gap would move the pixels behind it, so it
    is an error.
    """
    def joined(order: str, value: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]), "")

    lines = (pixels.withColumn("c", F.char("v")).groupBy("img_id", "y")
             .agg(joined("x", "c").alias("line"), F.count("*").cast("int").alias("width"), (F.max("x") + 1).alias("x_end")))
    images = lines.groupBy("img_id").agg(
        F.count("*").cast("int").alias("height"), F.max("width").alias("width"),
        F.encode(joined("y", "line"), "ISO-8859-1").alias("data"), (F.max("y") + 1).alias("y_end"),
        F.max("x_end").alias("x_end"), F.min("width").alias("narrowest"))
    whole = (F.col("y_end") == F.col("height")) & (F.col("x_end") == F.col("width")) & (F.col("narrowest") == F.col("width"))
    gap = F.raise_error(F.concat(F.lit("pixels are missing or repeated in image "), F.col("img_id").cast("string"))).cast("binary")
    return images.select("img_id", "height", "width", F.when(whole, F.col("data")).otherwise(gap).alias("data"))


def gray(images: DataFrame) -> DataFrame:
    """Rows of Spark's ``image`` source -> gray pixel rows; unreadable files drop out.

    Colour pixels (blue, green, red) become 0.299 R + 0.587 G + 0.114 B, rounded.
    """
    ok = images.where(F.col("image.height") > 0).select("img_id", "image.*")
    bytes_ = F.transform(F.split(F.decode("data", "ISO-8859-1"), ""), lambda c: F.ascii(c))
    places = F.sequence(F.lit(0), F.expr("height * width - 1"))

    def channel(i: Column, c: int) -> Column:
        return F.get(F.col("bytes"), i * F.col("nChannels") + c)

    def value(i: Column) -> Column:
        colour = F.round(0.299 * channel(i, 2) + 0.587 * channel(i, 1) + 0.114 * channel(i, 0)).cast("int")
        return F.when(F.col("nChannels") == 1, channel(i, 0)).otherwise(colour)

    return _value_rows(ok.withColumn("bytes", bytes_), F.transform(places, value))


# Per-image facts ----------------------------------------------------------


def image_facts(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("img_id").agg(
        (F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"), F.max("v").alias("v_max"))


def with_image_facts(pixels: DataFrame) -> DataFrame:
    return join_per_key(pixels, image_facts(pixels), "img_id", ["y", "x"])


def pixel_scale(pixels: DataFrame) -> DataFrame:
    """Divide by 255 only in images holding some pixel above 1."""
    scaled = F.when(F.col("v_max") > 1, F.col("v") / F.lit(255.0)).otherwise(F.col("v").cast("double"))
    return with_image_facts(pixels).select("img_id", "y", "x", scaled.alias("value"))


def pixel_flip(pixels: DataFrame, horizontal: Column | None = None, vertical: Column | None = None,
               augment: Column | None = None, seed: int = 0) -> DataFrame:
    """Mirror images; each coin is a repeatable hash of the image id unless given.

    The same coins applied to a mask table keep image and mask in step.
    """
    def coin(n: int) -> Column:
        return F.pmod(F.xxhash64("img_id", F.lit(seed), F.lit(n)), F.lit(2)) == 1

    chosen = coin(0) if augment is None else augment
    across = chosen & (coin(1) if horizontal is None else horizontal)
    down = chosen & (coin(2) if vertical is None else vertical)
    return (with_image_facts(pixels)
            .withColumn("x", F.when(across, F.col("w") - 1 - F.col("x")).otherwise(F.col("x")))
            .withColumn("y", F.when(down, F.col("h") - 1 - F.col("y")).otherwise(F.col("y")))
            .drop("h", "w", "v_max"))


def mask_resize_nearest(pixels: DataFrame, scale: float) -> DataFrame:
    """Shrink to ``int(scale * size)`` by nearest pixel.

    A target pixel reads source ``floor((t + 0.5) * size / new)``. As targets
    are no more than sources, each source feeds at most one target, found by
    whole-number arithmetic on its own row.
    """
    if not 0 < scale <= 1:
        raise ValueError("scale must be above 0 and at most 1")

    def new_size(size: str) -> Column:
        new = F.floor(F.col(size) * F.lit(float(scale))).cast("bigint")
        return F.when(new > 0, new).otherwise(
            F.raise_error(F.lit("scale is too small, an image would have no pixel")).cast("bigint"))

    def target(source: str, size: str, new: str) -> Column:
        # Smallest t whose source is not before this one: ceil((2 s new - size) / (2 size)).
        ahead = f"2L * {source} * {new} - {size}"
        return F.expr(f"if({ahead} > 0, ({ahead} + 2L * {size} - 1) div (2L * {size}), 0L)")

    sized = with_image_facts(pixels).withColumn("nh", new_size("h")).withColumn("nw", new_size("w"))
    placed = sized.withColumn("ty", target("y", "h", "nh")).withColumn("tx", target("x", "w", "nw"))
    hit = (F.expr("ty < nh and ((2L * ty + 1) * h) div (2L * nh) = y")
           & F.expr("tx < nw and ((2L * tx + 1) * w) div (2L * nw) = x"))
    return placed.where(hit).select("img_id", F.col("ty").cast("int").alias("y"), F.col("tx").cast("int").alias("x"), "v")


def crop_boxes(pixels: DataFrame, boxes: DataFrame, gain: float = 1.0, pad: float = 0.0, tile: int = TILE) -> DataFrame:
    """Pixels inside each box as a new image with local coordinates.

    Boxes are listed per tile they touch, so the join has (image, tile) as its
    key and the box test only runs on pixels nearby. ``gain`` and ``pad`` widen
    the box around its centre before it is clipped to the image.
    """
    def edge(low: str, high: str, sign: int) -> Column:
        if gain == 1.0 and pad == 0.0:
            return F.col(low if sign < 0 else high)
        half = ((F.col(high) - F.col(low)) * F.lit(float(gain)) + F.lit(float(pad))) / 2
        return F.floor((F.col(low) + F.col(high)) / 2 + sign * half).cast("int")

    grown = boxes.select(
        "img_id", "det_no",
        F.greatest(F.lit(0), edge("x1", "x2", -1)).alias("bx1"), F.greatest(F.lit(0), edge("y1", "y2", -1)).alias("by1"),
        edge("x1", "x2", 1).alias("bx2"), edge("y1", "y2", 1).alias("by2"),
    )
    # A box may reach far beyond its image; tiles are listed inside the image only.
    edges = image_facts(pixels).select("img_id", "h", "w")
    grown = grown.join(edges, "img_id").withColumn("bx2", F.least("bx2", "w")).withColumn("by2", F.least("by2", "h"))
    grown = grown.drop("h", "w").where("bx2 > bx1 and by2 > by1")
    listed = (grown.withColumn("ty", F.explode(F.expr(f"sequence(by1 div {tile}, (by2 - 1) div {tile})")))
              .withColumn("tx", F.explode(F.expr(f"sequence(bx1 div {tile}, (bx2 - 1) div {tile})"))))
    tiled = pixels.withColumn("ty", F.expr(f"y div {tile}")).withColumn("tx", F.expr(f"x div {tile}"))
    inside = tiled.join(listed, _CORNER).where("y >= by1 and y < by2 and x >= bx1 and x < bx2")
    return inside.select("img_id", "det_no", (F.col("y") - F.col("by1")).alias("y"),
                         (F.col("x") - F.col("bx1")).alias("x"), "v")


# Histograms and Otsu ------------------------------------------------------


def gray_histogram(pixels: DataFrame, value: str = "v") -> DataFrame:
    return pixels.groupBy("img_id", F.col(value).alias("v")).agg(F.count("*").alias("n"))


def running_histogram(histogram: DataFrame) -> DataFrame:
    """Cumulative count and weighted sum per image; at most 256 rows per image."""
    upto = Window.partitionBy("img_id").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (histogram.withColumn("n_upto", F.sum("n").over(upto))
            .withColumn("s_upto", F.sum(F.col("n") * F.col("v")).over(upto)))


def otsu_levels(histogram: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Otsu level per image: largest between-class variance, the lowest level on a tie.

    An image of one value has level 0. The maximum of the ``carry`` columns
    comes along.
    """
    whole = Window.partitionBy("img_id")
    totals = (running_histogram(histogram).withColumn("n_all", F.max("n_upto").over(whole))
              .withColumn("s_all", F.max("s_upto").over(whole)))
    n1, n2 = F.col("n_upto").cast("double"), (F.col("n_all") - F.col("n_upto")).cast("double")
    lean = F.col("n_all").cast("double") * F.col("s_upto") - n1 * F.col("s_all")
    # Classes below single-precision resolution are not split off.
    enough = F.least(n1, n2) / F.col("n_all") >= 1.1920929e-07
    variance = F.when(enough, lean * lean / (n1 * n2))
    level = F.max_by("v", F.when(variance > 0, F.struct(variance, -F.col("v"))))
    return totals.groupBy("img_id").agg(
        F.coalesce(level, F.lit(0)).alias("level"), *[F.max(c).alias(c) for c in carry])


def otsu_threshold(pixels: DataFrame, value: str = "v") -> DataFrame:
    """255 above the Otsu level of the image, else 0, as column ``e``."""
    levels = otsu_levels(gray_histogram(pixels, value))
    e = F.when(F.col(value) > F.col("level"), 255).otherwise(0)
    return join_per_key(pixels, levels, "img_id", ["y", "x"]).withColumn("e", e).drop("level")


# Neighbourhoods -----------------------------------------------------------


def to_tiles(pixels: DataFrame, margin: int, tile: int = TILE) -> DataFrame:
    """Deal pixels to tiles (ty, tx); pixels near a border also go to the neighbours."""
    def touched(axis: str) -> Column:
        return F.explode(F.expr(
            f"sequence(greatest(0, {axis} - {margin}) div {tile}, ({axis} + {margin}) div {tile})"))

    return (pixels.withColumn("ty", touched("y")).withColumn("tx", touched("x"))
            .repartition(*_CORNER))


def _within(tile: int, margin: int = 0) -> Column:
    return F.expr(" and ".join(
        f"{a} >= t{a} * {tile} - {margin} and {a} < (t{a} + 1) * {tile} + {margin}" for a in "yx"))


def _lines(k: int):
    """Windows of half-width k along a row and along a column of a tile."""
    along_x = Window.partitionBy(*_CORNER, "y").orderBy("x").rangeBetween(-k, k)
    along_y = Window.partitionBy(*_CORNER, "x").orderBy("y").rangeBetween(-k, k)
    return along_x, along_y


def _window_list(tiled: DataFrame, k: int, cell: Column, name: str) -> DataFrame:
    """Row-major list of the cells in each pixel's clamped window."""
    along_x, along_y = _lines(k)
    return (tiled.withColumn("_line", F.collect_list(cell).over(along_x))
            .withColumn(name, F.flatten(F.collect_list("_line").over(along_y))).drop("_line"))


def pixel_window_join(pixels: DataFrame, window_size: int, tile: int = TILE) -> DataFrame:
    """Each pixel with its neighbours in the clamped window of half-width ``window_size // 2``."""
    k = window_size // 2
    tiled = _window_list(to_tiles(pixels, k, tile), k, F.struct("y", "x", "v"), "near")
    return (tiled.where(_within(tile)).select("img_id", "y", "x", "v", F.explode("near").alias("n"))
            .select("img_id", "y", "x", "v", F.col("n.y").alias("ny"), F.col("n.x").alias("nx"), F.col("n.v").alias("nv")))


def _contrast(tiled: DataFrame, k: int, mode: str) -> DataFrame:
    along_x, along_y = _lines(k)
    spread = (tiled.withColumn("_hi", F.max("v").over(along_x)).withColumn("_lo", F.min("v").over(along_x))
              .withColumn("_hi", F.max("_hi").over(along_y)).withColumn("_lo", F.min("_lo").over(along_y)))
    total = F.col("_hi") + F.col("_lo")
    if mode == "reference":
        total = total % 256  # the sum is kept in one byte
    value = ((F.col("_hi") - F.col("_lo")) / (total + F.lit(0.001))).cast("float")
    return spread.withColumn("c", F.least(value, F.lit(1.0).cast("float"))).drop("_hi", "_lo")


def _check_mode(mode: str) -> None:
    if mode not in ("reference", "paper"):
        raise ValueError(f"unknown mode {mode!r}")


def local_contrast(pixels: DataFrame, window_size: int, mode: str = "reference", tile: int = TILE) -> DataFrame:
    """Contrast ``(max - min) / (max + min + 0.001)`` of each pixel's window, at most 1.

    Mode "reference" keeps ``max + min`` in one byte; "paper" does not.
    """
    _check_mode(mode)
    k = window_size // 2
    return _contrast(to_tiles(pixels, k, tile), k, mode).where(_within(tile)).drop("ty", "tx")


def _contrast_level() -> Column:
    return F.floor(F.col("c") * F.lit(255).cast("float")).cast("int")


def _decide_reference(tiled: DataFrame, k: int, n_min: int) -> DataFrame:
    """Byte arithmetic: weights are 1 (low contrast) and 2 (high), products wrap at
    256, and the centre is taken out as the first equal value of each list."""
    near = _window_list(tiled, k, F.struct("e", "v"), "near")

    def without_first(values: str, value: str) -> Column:
        place = F.array_position(values, F.col(value)).cast("int")
        rest = F.size(values) - place
        return F.concat(F.slice(values, 1, place - 1), F.slice(values, place + 1, rest))

    lists = (near.withColumn("_e", F.col("near.e")).withColumn("_v", F.col("near.v"))
             .withColumn("_e", without_first("_e", "e")).withColumn("_v", without_first("_v", "v"))
             .drop("near"))
    weight = lambda e: F.when(e == 255, 2).otherwise(1)
    zero = F.lit(0.0)
    return (lists.withColumn("_n", F.size(F.filter("_e", lambda e: e == 255)))
            .withColumn("_sum", F.aggregate(F.zip_with("_e", "_v", lambda e, v: v * weight(e) % 256),
                                            F.lit(0), lambda s, p: s + p))
            .withColumn("_mean", F.when(F.col("_n") > 0, F.try_divide("_sum", "_n")).otherwise(zero))
            .withColumn("_std", F.sqrt(F.aggregate(
                F.zip_with("_e", "_v", lambda e, v: (v - F.col("_mean")) * weight(e)),
                zero, lambda s, d: s + d * d) / 2))
            .drop("_e", "_v", "_sum"))


def _decide_paper(tiled: DataFrame, k: int) -> DataFrame:
    """Mean and deviation over the high-contrast neighbours, from separable sums."""
    along_x, along_y = _lines(k)
    high = (F.col("e") == 255).cast("bigint")
    parts = {"_n": high, "_s": high * F.col("v"), "_q": high * F.col("v") * F.col("v")}
    sums = tiled
    for name, part in parts.items():
        sums = sums.withColumn(name, F.sum(part).over(along_x))
    for name, part in parts.items():
        sums = sums.withColumn(name, F.sum(name).over(along_y) - part)
    n = F.col("_n").cast("double")
    spread = (F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")).cast("double")
    return (sums.withColumn("_mean", F.coalesce(F.try_divide(F.col("_s").cast("double"), n), F.lit(0.0)))
            .withColumn("_std", F.coalesce(F.sqrt(F.try_divide(spread, n * n)), F.lit(0.0)))
            .drop("_s", "_q"))


def _decide(tiled: DataFrame, k: int, n_min: int, mode: str) -> DataFrame:
    judged = _decide_reference(tiled, k, n_min) if mode == "reference" else _decide_paper(tiled, k)
    ink = (F.col("_n") >= n_min) & (F.col("v") <= F.col("_mean") + F.col("_std") / 2)
    return judged.withColumn("b", F.when(ink, 0).otherwise(255)).drop("_n", "_mean", "_std")


def su_threshold(pixels: DataFrame, window_size: int, n_min: int, mode: str = "reference",
                 tile: int = TILE) -> DataFrame:
    """Ink decision ``b`` (0 ink, 255 paper) from gray ``v`` and contrast mask ``e``."""
    _check_mode(mode)
    if n_min < 1:
        raise ValueError("n_min must be at least 1")
    k = window_size // 2
    return _decide(to_tiles(pixels, k, tile), k, n_min, mode).where(_within(tile)).drop("ty", "tx")


def su_binarize(pixels: DataFrame, window_size: int, n_min: int, mode: str = "reference",
                tile: int = TILE) -> DataFrame:
    """Local contrast, Otsu on the contrast, then the ink decision.

    The pixels are shuffled once, to tiles with a double margin; both window
    steps run on that partitioning. The Otsu level comes back as one row per
    tile, so the join needs no shuffle of the pixels either.
    """
    _check_mode(mode)
    if n_min < 1:
        raise ValueError("n_min must be at least 1")
    k = window_size // 2
    tiled = _contrast(to_tiles(pixels.select("img_id", "y", "x", "v"), 2 * k, tile), k, mode)
    leveled = tiled.where(_within(tile, k)).withColumn("_level", _contrast_level()).drop("c")
    per_tile = leveled.where(_within(tile)).groupBy(*_CORNER, F.col("_level").alias("v")).agg(F.count("*").alias("n"))
    histogram = per_tile.groupBy("img_id", "v").agg(
        F.sum("n").alias("n"), F.max("ty").alias("my"), F.max("tx").alias("mx"))
    levels = (otsu_levels(histogram, ("my", "mx"))
              .withColumn("ty", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("my"))))
              .withColumn("tx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("mx"))))
              .select(*_CORNER, "level"))
    masked = leveled.join(levels, _CORNER).withColumn(
        "e", F.when(F.col("_level") > F.col("level"), 255).otherwise(0)).drop("_level", "level")
    return _decide(masked, k, n_min, mode).where(_within(tile)).select("img_id", "y", "x", "v", "e", "b")
