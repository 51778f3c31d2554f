"""Similar words compared in clusters: the same rows, fewer pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkfold.operators import similarity


def rows_of(df):
    return {(r.doc_id, r.word, r.similar_word, round(r.cosine, 9), r.n_pairs) for r in df.collect()}


def plain_pairs(rows, threshold):
    out = {}
    for i, (d, p, w, v) in enumerate(rows):
        for j, (e, q, x, u) in enumerate(rows):
            if i != j and d == e and v is not None and u is not None:
                norm = np.linalg.norm(v) * np.linalg.norm(u)
                cosine = float(np.dot(v, u) / norm) if norm else 0.0
                if cosine > threshold:
                    best, n = out.get((d, w, x), (-1.0, 0))
                    out[d, w, x] = (max(best, cosine), n + 1)
    return {(*k, round(c, 9), n) for k, (c, n) in out.items()}


def clustered(spark, seed, n_docs=2, per_center=30, centers=8, spread=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(n_docs):
        for c, center in enumerate(rng.normal(size=(centers, 16))):
            for i in range(per_center):
                rows.append((d, len(rows), f"w{c}-{i % (per_center - 3)}", [float(x) for x in center + spread * rng.normal(size=16)]))
    rows += [(0, 10 ** 6, "zero", [0.0] * 16), (0, 10 ** 6 + 1, "none", None), (7, 0, "alone", [1.0] * 16), (7, 1, "alone", [1.0] * 16), (7, 2, "far", [-1.0] * 16)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, pos int, word string, vec array<double>")


@pytest.mark.parametrize("threshold", [0.3, 0.9, 0.0])
def test_same_rows_as_all_pairs(spark, threshold):
    rows, df = clustered(spark, 3)
    want = plain_pairs(rows, threshold)
    assert rows_of(similarity.similar_token_join(df, threshold, block_words=20, by_angle=True)) == want
    assert rows_of(similarity.similar_token_join(df, threshold, block_words=20)) == want


def test_clusters_far_apart_never_meet(spark):
    _, df = clustered(spark, 5, n_docs=1, per_center=60)
    by_hash = similarity.compared_pairs(similarity.met_by_hash(df, block_words=30))
    by_angle = similarity.compared_pairs(similarity.met_by_angle(df, 0.9, block_words=30))
    assert by_angle < by_hash / 2
    # A block is bounded in any case, also where all vectors point one way.
    same = df.where("vec is not null").withColumn("vec", F.transform("vec", lambda x: x * 0 + 1.0 + F.col("pos") * 1e-9))
    met = similarity.met_by_angle(same.where("doc_id = 0"), 0.9, block_words=30)
    blocks = met.select("doc_id", "block", "word", "vec").distinct().groupBy("doc_id", "block").count()
    assert blocks.agg(F.max("count")).first()[0] < 90
    assert similarity.similar_token_join(df.limit(0), by_angle=True).count() == 0


def test_small_blocks_are_copied_by_tile(spark, monkeypatch):
    """Blocks much smaller than a tile: a word is copied once per tile it may meet, not once per block."""
    rows, df = clustered(spark, 11, n_docs=1, per_center=40)
    monkeypatch.setattr(similarity, "TILE_WORDS", 100)
    met = similarity.tiles_by_angle(df, 0.0, block_words=4)
    copies = met.groupBy("doc_id", "word", "vec").count().agg(F.max("count")).first()[0]
    by_block = similarity.met_by_angle(df, 0.0, block_words=4).groupBy("doc_id", "word", "vec").count().agg(F.max("count")).first()[0]
    assert copies <= 8 < by_block
    largest = met.select("doc_id", "block", "word", "vec").distinct().groupBy("doc_id", "block").count().agg(F.max("count")).first()[0]
    assert largest <= 100
    assert rows_of(similarity.similar_token_join(df, 0.5, block_words=4, by_angle=True)) == plain_pairs(rows, 0.5)
    # Clusters larger than a tile are cut; words may be null.
    same = df.where("vec is not null").withColumn("vec", F.transform("vec", lambda x: x * 0 + 1.0 + F.col("pos") * 1e-9)).withColumn("word", F.nullif("word", F.lit("w1-1")))
    plain = [(r.doc_id, r.pos, r.word, r.vec) for r in same.collect()]
    assert rows_of(similarity.similar_token_join(same, 0.9, block_words=20, by_angle=True)) == plain_pairs(plain, 0.9)
