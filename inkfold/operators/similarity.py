"""Similar words by cosine, and a two-dimensional view of word vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.functions.fixed_values import SIMILARITY_THRESHOLD
from inkfold.operators.joins import join_per_key
from inkfold.sources.files import work_folder

# Words of a document per block; two blocks are compared in one step.
BLOCK_WORDS = 1024
# Words of a document per tile, where blocks are smaller: what is copied and compared in one step.
TILE_WORDS = 2048
# Words of one tile whose cosines with another are held at once.
HELD_ROWS = 128
# Pivots of a document; where it has more blocks its clusters are larger.
MOST_PIVOTS = 1024
# Blocks of one cluster are numbered below this.
CLUSTER_BLOCKS = 1 << 20
# Directions of all labels of one group that every task and the driver hold.
SPREAD_BYTES = 1 << 27
# Labels whose sums a task holds before it passes them on.
HELD_LABELS = 256


def has_vector(tokens: DataFrame) -> DataFrame:
    return tokens.where(F.col("vec").isNotNull())


def _counted_words(tokens: DataFrame, block_words: int) -> DataFrame:
    """``doc_id, word, vec, n`` of distinct tokens with a vector, and the number of blocks of the document."""
    known = has_vector(tokens)
    items = known.groupBy("doc_id", "word", "vec").agg(F.count("*").alias("n"))
    # An estimate will do: the number of blocks only sets their size.
    n_items = F.approx_count_distinct(F.xxhash64("word", "vec"))
    blocks = known.groupBy("doc_id").agg(F.ceil(n_items / block_words).cast("int").alias("n_blocks"))
    return join_per_key(items, blocks, "doc_id", ["word"])


def _met(placed: DataFrame) -> DataFrame:
    """``low, high``: the cells in which a word's ``block`` meets the blocks listed in ``others``."""
    return (placed.withColumn("other", F.explode("others")).drop("others")
            .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))


def met_by_hash(tokens: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words dealt to blocks by hash; every two blocks of a document meet."""
    placed = _counted_words(tokens, block_words).withColumn("block", F.pmod(F.hash("word", "vec"), "n_blocks").cast("bigint"))
    return _met(placed.withColumn("others", F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks").cast("bigint") - 1))).drop("n_blocks", "other")


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; those without a direction become zeros."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    fine = np.isfinite(norms) & (norms > 0)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=np.broadcast_to(fine, vectors.shape))


def _clustered_by_angle(tokens: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame]:
    """Words with their ``cluster`` and ``angle`` to its pivot; and per document ``clusters, sizes, radii, pivots``."""
    spark = tokens.sparkSession
    folder = work_folder(spark, "similar-words")
    items = _counted_words(tokens, block_words)
    # An even number per word; the smallest share of a document are its pivots.
    even = (F.pmod(F.xxhash64("word", "vec"), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("even")
    items.select("*", even).write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    sizes = items.groupBy("doc_id").agg((F.least(F.max("n_blocks"), F.lit(MOST_PIVOTS)) / F.count("*")).alias("share"))
    chosen = join_per_key(items, sizes, "doc_id", ["word"]).where((F.col("n_blocks") > 1) & (F.col("even") < F.col("share")))
    pivots = chosen.groupBy("doc_id").agg(F.collect_list("vec").alias("pivots"))
    n_parts = F.ceil(F.col("n_blocks") * F.lit(block_words) / F.lit(TILE_WORDS)).cast("int")
    parts = items.groupBy("doc_id", F.pmod(F.hash("word", "vec"), n_parts).alias("part")).agg(F.collect_list(F.struct("word", "n", "vec")).alias("items"))
    dealt = parts.join(pivots, "doc_id", "left").select(
        "doc_id", F.col("items.word").alias("words"), F.col("items.n").alias("counts"), F.flatten("items.vec").alias("numbers"),
        F.flatten("pivots").alias("pivots"), F.coalesce(F.size("pivots"), F.lit(0)).alias("n_pivots"))
    # Vectors of single precision stay so where they are stored and copied.
    narrow = tokens.schema["vec"].dataType.simpleString() == "array<float>"

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g in batch.itertuples(index=False):
                vectors = np.asarray(g.numbers, dtype=np.float64).reshape(len(g.words), -1)
                unit = _unit(vectors)
                keep = unit.any(axis=1)
                own = _directions(g.pivots, g.n_pivots)
                # Without pivots all words are one cluster, too wide to skip anything.
                nearest, angle = np.zeros(keep.sum(), dtype="i8"), np.full(keep.sum(), np.pi)
                if own is not None:
                    cosine = unit[keep] @ own.T
                    nearest = cosine.argmax(axis=1)
                    angle = np.arccos(np.clip(cosine[np.arange(len(nearest)), nearest], -1, 1))
                yield pd.DataFrame({"doc_id": g.doc_id, "word": np.asarray(g.words, dtype=object)[keep], "n": np.asarray(g.counts)[keep],
                                    "vec": list(vectors[keep].astype(np.float32 if narrow else np.float64)), "cluster": nearest, "angle": angle})
    dealt.mapInPandas(assign, f"doc_id bigint, word string, n bigint, vec array<{'float' if narrow else 'double'}>, cluster bigint, angle double"
                      ).write.parquet(f"{folder}/clusters")
    clustered = spark.read.parquet(f"{folder}/clusters")
    radii = clustered.groupBy("doc_id", "cluster").agg(F.count("*").alias("size"), F.max("angle").alias("radius"))
    per_doc = radii.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("cluster", "size", "radius"))).alias("c")).join(pivots, "doc_id", "left").select(
        "doc_id", F.col("c.cluster").alias("clusters"), F.col("c.size").alias("sizes"), F.col("c.radius").alias("radii"),
        F.flatten("pivots").alias("pivots"), F.coalesce(F.size("pivots"), F.lit(0)).alias("n_pivots"))
    return clustered, per_doc


def _near(directions: np.ndarray | None, radii: np.ndarray, threshold: float) -> np.ndarray:
    """Which clusters may hold a similar pair: not those further apart than both radii and the angle of the threshold."""
    angle = np.zeros((len(radii), len(radii)))
    if directions is not None:
        angle = np.arccos(np.clip(directions @ directions.T, -1, 1))
    # A little more than the bound, for rounding.
    near = angle - np.add.outer(radii, radii) <= np.arccos(threshold) + 1e-6
    np.fill_diagonal(near, True)
    return near


def met_by_angle(tokens: DataFrame, threshold: float = SIMILARITY_THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words dealt to blocks by their nearest pivot; only blocks that may hold a similar pair meet.

    About as many words of a document as it has blocks are its pivots, by hash. A
    cluster are the words nearest to a pivot, and its radius the largest angle between
    them. Angles obey the triangle inequality, so two clusters whose pivots are further
    apart than both radii and the angle of the threshold hold no similar pair: their
    blocks never meet, and a word is copied only to where it may. Large clusters
    are cut by hash. A vector without a direction is similar to nothing and drops out.

    Small blocks that all may meet copy a word once per block; ``tiles_by_angle`` copies it
    once per tile of several blocks.
    """
    clustered, per_doc = _clustered_by_angle(tokens, block_words)

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g in batch.itertuples(index=False):
                clusters, cuts = np.asarray(g.clusters), -(-np.asarray(g.sizes) // block_words)
                own = _directions(g.pivots, g.n_pivots)
                near = _near(None if own is None else own[clusters], np.asarray(g.radii), threshold)
                for i, c in enumerate(clusters):
                    others = np.concatenate([clusters[j] * CLUSTER_BLOCKS + np.arange(cuts[j]) for j in np.flatnonzero(near[i])])
                    yield pd.DataFrame({"doc_id": [g.doc_id], "cluster": [c], "cuts": [cuts[i]], "others": [others]})
    meets = per_doc.mapInPandas(bounds, "doc_id bigint, cluster bigint, cuts bigint, others array<bigint>")
    block = F.col("cluster") * CLUSTER_BLOCKS + F.pmod(F.hash("word", "vec").cast("bigint"), F.col("cuts"))
    placed = clustered.join(meets, ["doc_id", "cluster"]).withColumn("block", block)
    return _met(placed.drop("cluster", "angle", "cuts")).drop("other")


def tiles_by_angle(tokens: DataFrame, threshold: float = SIMILARITY_THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The clusters of ``met_by_angle`` packed into tiles; ``block`` is the tile, ``cluster`` stays with the word.

    A word is copied to the tiles that hold a cluster it may be similar to, so copies do not
    grow with the number of blocks but with that of tiles. A cluster larger than a tile is cut by hash.
    """
    clustered, per_doc = _clustered_by_angle(tokens, block_words)
    tile_words = max(TILE_WORDS, block_words)

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g in batch.itertuples(index=False):
                clusters, cuts = np.asarray(g.clusters), -(-np.asarray(g.sizes) // tile_words)
                own = _directions(g.pivots, g.n_pivots)
                near = _near(None if own is None else own[clusters], np.asarray(g.radii), threshold)
                first, last, room = [], -1, 0
                for size, n in zip(g.sizes, cuts.tolist()):
                    if size > room:
                        last, room = last + 1, tile_words
                    first.append(last)
                    last, room = last + n - 1, room - size if n == 1 else 0
                first = np.array(first)
                others = [np.unique(np.concatenate([first[j] + np.arange(cuts[j]) for j in np.flatnonzero(row)])) for row in near]
                yield pd.DataFrame({"doc_id": g.doc_id, "cluster": clusters, "cuts": cuts, "first": first, "others": others})
    meets = per_doc.mapInPandas(bounds, "doc_id bigint, cluster bigint, cuts bigint, first bigint, others array<bigint>")
    tile = F.col("first") + F.pmod(F.hash("word", "vec").cast("bigint"), F.col("cuts"))
    placed = clustered.join(meets, ["doc_id", "cluster"]).withColumn("block", tile)
    return _met(placed.drop("angle", "cuts", "first")).drop("other")


def _similar_places(vectors: np.ndarray, cluster: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of similar unit vectors of two sides, and their cosines; clusters too far apart are not compared."""
    # Any direction may be the middle of a cluster: here the mean of its vectors on either side.
    ids, own = np.unique(cluster, return_inverse=True)
    sums = np.zeros((len(ids), vectors.shape[1]))
    np.add.at(sums, own, vectors)
    middles = _unit(sums)
    radii = np.zeros(len(ids))
    np.maximum.at(radii, own, np.arccos(np.clip(np.einsum("ij,ij->i", vectors, middles[own]), -1, 1)))
    radii[~middles.any(axis=1)] = np.pi
    near = _near(middles, radii, threshold)
    left = left[np.argsort(own[left], kind="stable")]
    found = []
    for at in range(0, len(left), HELD_ROWS):
        some = left[at:at + HELD_ROWS]
        others = right[near[own[some]].any(axis=0)[own[right]]]
        cosine = vectors[some] @ vectors[others].T
        i, j = np.nonzero(cosine > threshold)
        found.append((some[i], others[j], cosine[i, j]))
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, (none, none, np.zeros(0))))


def _directions(pivots, n_pivots: int) -> np.ndarray | None:
    """Unit pivots from their numbers in a row; None without any, or if one has no direction."""
    if not n_pivots:
        return None
    own = _unit(np.asarray(pivots, dtype=np.float64).reshape(n_pivots, -1))
    return own if own.any(axis=1).all() else None


def compared_pairs(met: DataFrame) -> int:
    """Pairs of words that meet in a cell, each side counted as it is compared."""
    cells = met.groupBy("doc_id", "low", "high").agg(
        F.count_if(F.col("block") == F.col("low")).alias("a"), F.count_if(F.col("block") == F.col("high")).alias("b"))
    return cells.agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0


def similar_token_join(tokens: DataFrame, threshold: float = SIMILARITY_THRESHOLD,
                       block_words: int = BLOCK_WORDS, by_angle: bool = False) -> DataFrame:
    """Similar word pairs within each document.

    One row per (document, word, other word) with the cosine and ``n_pairs``,
    the number of ordered token pairs it stands for; a token is not paired with
    itself, but with the same word elsewhere.

    Equal tokens are counted first, so a frequent word is one item. The items
    of a document are dealt to blocks by hash and every two blocks meet in a
    group of their own: no group outgrows two blocks and only pairs above the
    threshold are emitted. With ``by_angle`` words are clusters of like vectors, packed
    into tiles, and those too far apart are never compared (see ``tiles_by_angle``), which
    pays where documents have many blocks; the rows are the same.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    met = tiles_by_angle(tokens, threshold, block_words) if by_angle else met_by_hash(tokens, block_words).withColumn("cluster", F.lit(0).cast("bigint"))
    groups = (met.groupBy("doc_id", "low", "high")
              .agg(F.collect_list(F.struct("word", "n", "block", "cluster", "vec")).alias("items"))
              .select("doc_id", "low", "high", F.col("items.word").alias("words"), F.col("items.n").alias("counts"),
                      F.col("items.block").alias("blocks"), F.col("items.cluster").alias("clusters"), F.flatten("items.vec").alias("numbers")))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g in batch.itertuples(index=False):
                words, counts, block = np.asarray(g.words, dtype=object), np.asarray(g.counts), np.asarray(g.blocks)
                vectors = np.asarray(g.numbers, dtype=np.float64).reshape(len(words), -1)
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
                left, right = np.flatnonzero(block == g.low), np.flatnonzero(block == g.high)
                a, b, value = _similar_places(vectors, np.asarray(g.clusters), left, right, threshold)
                if g.low != g.high:
                    a, b, value = np.r_[a, b], np.r_[b, a], np.r_[value, value]
                pairs = counts[a] * np.where(a == b, counts[b] - 1, counts[b])
                keep = pairs > 0
                # Equal pairs of words leave as one row.
                codes, names = pd.factorize(words, use_na_sentinel=False)
                found = pd.DataFrame({"key": codes[a[keep]] * len(names) + codes[b[keep]], "cosine": value[keep], "n_pairs": pairs[keep]})
                found = found.groupby("key", as_index=False, sort=False).agg({"cosine": "max", "n_pairs": "sum"})
                key = found["key"].to_numpy()
                yield pd.DataFrame({
                    "doc_id": g.doc_id, "word": names[key // len(names)], "similar_word": names[key % len(names)],
                    "cosine": found["cosine"], "n_pairs": found["n_pairs"],
                })

    pairs = groups.mapInPandas(
        compare, "doc_id bigint, word string, similar_word string, cosine double, n_pairs bigint")
    return pairs.groupBy("doc_id", "word", "similar_word").agg(
        F.max("cosine").alias("cosine"), F.sum("n_pairs").alias("n_pairs"))


def similar_word_pairs(pairs: DataFrame) -> DataFrame:
    """Words and their similar words over all documents, each pair once, with its best cosine and the token pairs behind it.

    The long form of ``similar_words``: no row grows with the vocabulary, so a word
    similar to very many others is many small rows.
    """
    return pairs.groupBy("word", "similar_word").agg(F.max("cosine").alias("cosine"), F.sum("n_pairs").alias("n_pairs"))


def similar_words(pairs: DataFrame) -> DataFrame:
    """Per word over all documents, its distinct similar words in order.

    The array of a word is bounded by the vocabulary: pairs are made distinct
    before they are gathered. Where that is too wide for a row, use ``similar_word_pairs``.
    """
    distinct = pairs.select("word", "similar_word").distinct()
    return distinct.groupBy("word").agg(F.array_sort(F.collect_list("similar_word")).alias("similar_words"))


def similar_words_text(words: DataFrame) -> DataFrame:
    return words.select("word", F.array_join("similar_words", ", ").alias("similar_words"))


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two (word, similar_words) tables, the sets of a word merged."""
    long = a.unionByName(b).select("word", F.explode("similar_words").alias("similar_word"))
    return similar_words(long)


def _by_label(vectors: DataFrame, label: str, vec: str) -> DataFrame:
    """``label, vec`` and ``key``: vectors without a label are a group of their own."""
    named = vectors.withColumn("label", F.col(label).cast("string")).withColumn("vec", F.col(vec))
    return named.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit("")))


def _projected(named: DataFrame, views: DataFrame) -> DataFrame:
    """``px, py`` of every vector from ``key, mean, axis1, axis2``."""
    # The vectors of a label are dealt by row, so equal ones do not share a part.
    placed = named.withColumn("_row", F.monotonically_increasing_id())
    joined = join_per_key(placed, views, "key", ["_row"]).drop("_row", "key")

    def project(axis: str):
        centred = F.zip_with("vec", "mean", lambda v, m: v - m)
        return F.aggregate(F.zip_with(centred, axis, lambda c, w: c * w), F.lit(0.0), lambda s, p: s + p)

    return (joined.withColumn("px", project("axis1")).withColumn("py", project("axis2"))
            .drop("mean", "axis1", "axis2"))


def _signed(axes: np.ndarray) -> np.ndarray:
    """Axes (as columns) whose largest entry is positive."""
    return axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)


def _label_sums(named: DataFrame, held: dict, work) -> dict:
    """Per key the sum of ``work(state, rows)`` over its vectors: inside each task, then of a few tasks, then in one.

    ``held`` is what every task must know, by key; its size is bounded by the caller.
    """
    def add(sums: dict, key, value) -> None:
        sums[key] = sums[key] + value if key in sums else value

    def rows_of(sums: dict) -> Iterator[pd.DataFrame]:
        for key, value in sums.items():
            yield pd.DataFrame({"key": [key], "value": [np.ascontiguousarray(value).ravel()]})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for key, rows in batch.groupby("key"):
                if key in held:
                    add(sums, key, work(held[key], np.stack(rows["vec"].to_numpy()).astype(np.float64)))
        yield from rows_of(sums)

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for key, value in zip(batch["key"], batch["value"]):
                add(sums, key, np.asarray(value))
        yield from rows_of(sums)
    schema = "key string, value array<double>"
    by_task = named.select("key", "vec").mapInPandas(partial, schema)
    few = by_task.repartition(16, F.xxhash64("value")).mapInPandas(total, schema)
    return {r["key"]: np.asarray(r["value"]) for r in few.repartition(1).mapInPandas(total, schema).collect()}


def label_spread_wide(vectors: DataFrame, label: str = "label", vec: str = "vec", rank: int = 16, passes: int = 4) -> DataFrame:
    """``label_spread`` for vectors so wide that no matrix of their size squared should be built.

    Two principal components per label from a random start: a block of ``rank``
    directions is multiplied by the covariance ``passes`` times, each time in one pass over the
    vectors, and all blocks together are the space in which the components are
    found (exactly, where they are as many as the width). What is added up is width
    times ``rank`` per label; labels are taken in groups so that the state of a group
    stays below ``SPREAD_BYTES``. Vectors are read once per pass, so a dear input should be stored.
    """
    named = _by_label(vectors, label, vec).where(F.col("vec").isNotNull())
    keys = sorted((r["key"], r["width"]) for r in named.groupBy("key").agg(F.max(F.size("vec")).alias("width")).collect())
    views, at = [], 0
    while at < len(keys):
        upto, room = at, SPREAD_BYTES
        while upto < len(keys) and (upto == at or room >= 0):
            room -= 8 * keys[upto][1] * rank * (passes + 2)
            upto += 1
        views += _krylov_axes(named.where(F.col("key").isin([k for k, _ in keys[at:upto]])), dict(keys[at:upto]), rank, passes)
        at = upto
    schema = "key string, mean array<double>, axis1 array<double>, axis2 array<double>"
    return _projected(named, vectors.sparkSession.createDataFrame(views, schema))


def _krylov_axes(named: DataFrame, widths: dict[str, int], rank: int, passes: int) -> list[tuple]:
    sums = _label_sums(named, widths, lambda _, x: np.r_[len(x), x.sum(axis=0)])
    mean = {k: s[1:] / s[0] for k, s in sums.items()}
    rng = np.random.default_rng(0)
    start = {k: np.linalg.qr(rng.normal(size=(w, min(rank, w))))[0] for k, w in sorted(widths.items())}
    basis, block = {k: [q] for k, q in start.items()}, start

    def times(state: tuple, x: np.ndarray) -> np.ndarray:
        centred = x - state[0]
        return centred.T @ (centred @ state[1])

    def inside(state: tuple, x: np.ndarray) -> np.ndarray:
        y = (x - state[0]) @ state[1]
        return y.T @ y
    for _ in range(passes):
        found = _label_sums(named, {k: (mean[k], block[k]) for k in block}, times)
        block = {}
        for k, y in found.items():
            known = np.hstack(basis[k])
            # What is new in it; nothing, once the space is whole.
            y = y.reshape(widths[k], -1)
            y = y / max(np.abs(y).max(), np.finfo(float).tiny)
            for _ in range(2):
                y = y - known @ (known.T @ y)
            u, size, _ = np.linalg.svd(y, full_matrices=False)
            fresh = u[:, (size > 1e-12)][:, :widths[k] - known.shape[1]]
            if fresh.shape[1]:
                basis[k].append(fresh)
                block[k] = fresh
        if not block:
            break
    whole = {k: np.hstack(q) for k, q in basis.items()}
    found = _label_sums(named, {k: (mean[k], q) for k, q in whole.items()}, inside)
    out = []
    for k, q in whole.items():
        small = found[k].reshape(q.shape[1], q.shape[1])
        axes = _signed(q @ np.linalg.eigh(small)[1][:, ::-1][:, :2])
        if axes.shape[1] < 2:
            axes = np.c_[axes, np.zeros(len(axes))]
        out.append((k, mean[k].tolist(), axes[:, 0].tolist(), axes[:, 1].tolist()))
    return out


def label_spread(vectors: DataFrame, label: str = "label", vec: str = "vec") -> DataFrame:
    """First two principal components of each vector within its label (no label: a group of its own).

    Sums are added up inside a task first (a matrix of vector size squared per
    label), then per label; only that matrix is decomposed, once per label.
    """
    def moment_rows(sums: dict) -> Iterator[pd.DataFrame]:
        for name, moments in sums.items():
            yield pd.DataFrame({
                "key": name, "place": np.arange(moments.size), "size": moments.shape[0], "value": moments.ravel()})
        sums.clear()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for name, rows in batch.groupby("key"):
                x = np.stack(rows["vec"].to_numpy()).astype(np.float64)
                x = np.c_[np.ones(len(x)), x]
                sums[name] = sums.get(name, 0.0) + x.T @ x
            if len(sums) > HELD_LABELS:
                yield from moment_rows(sums)
        yield from moment_rows(sums)

    def axes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                moments = np.asarray(row.moments).reshape(row.size, row.size)
                n, mean = moments[0, 0], moments[0, 1:] / moments[0, 0]
                cov = moments[1:, 1:] / n - np.outer(mean, mean)
                top = np.linalg.eigh(cov)[1][:, ::-1][:, :2]
                top = top * np.where(top[np.abs(top).argmax(axis=0), [0, 1]] < 0, -1.0, 1.0)
                yield pd.DataFrame({
                    "key": [row.key], "mean": [mean], "axis1": [top[:, 0]], "axis2": [top[:, 1]]})

    named = _by_label(vectors, label, vec)
    sums = named.select("key", "vec").mapInPandas(
        partial, "key string, place int, size int, value double")
    matrix = (sums.groupBy("key", "place", "size").agg(F.sum("value").alias("value"))
              .groupBy("key", "size").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
              .select("key", "size", F.col("cells.value").alias("moments")))
    views = matrix.mapInPandas(
        axes, "key string, mean array<double>, axis1 array<double>, axis2 array<double>")
    return _projected(named, views)
