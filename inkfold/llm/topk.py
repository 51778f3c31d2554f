"""Exact top-k inner products by MaxScore over vector shards.

The terms of a query are its dimensions. A shard knows the smallest and largest
value of each dimension, hence the most a dimension can add to a query's score.
Dimensions are ordered by that bound. The essential ones are scored for every
vector of the shard (their postings are dense columns); then the remaining ones
are probed, a few at a time, only for vectors whose score so far plus the bounds
still open reaches the k-th best score known. Shards give their k best, and the
best of those are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.common import tasks

# Vectors in a shard and queries in a block: what one task holds at once.
SHARD = 4096
BLOCK = 512
# Dimensions probed between two looks at the bounds.
STEP = 8
SCALE = 256
_OUT = "q bigint, part bigint, v bigint, score bigint"


def usable(vector: Column) -> Column:
    """Not null, and no component null, infinite or not a number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def quantized(vector: Column) -> Column:
    """floor(256 x) of every component, x as double; a whole number of any size, still as double."""
    def whole(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(float(SCALE))
        # From 2^52 on every double is whole, and floor() would end at 2^63.
        return F.when(F.abs(scaled) < F.lit(2.0 ** 52), F.floor(scaled).cast("double")).otherwise(scaled)
    return F.transform(vector, whole)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled with zeros."""
    if len(column) and all(len(row) == width for row in column):
        return np.concatenate(column.to_numpy()).astype("float64").reshape(-1, width)
    out = np.zeros((len(column), width))
    for i, row in enumerate(column):
        out[i, :len(row)] = row
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _exact(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """Like ``_search`` in Python's integers, for sums that doubles may not hold."""
    asked = [int(x) for x in query]
    scored = sorted((-sum(q * int(x) for q, x in zip(asked, row)), int(i)) for i, row in zip(ids, vectors) if i != own)[:k]
    if any(abs(s) >= 1 << 63 for s, _ in scored):
        raise OverflowError("a score does not fit into 64 bits")
    return np.array([i for _, i in scored], dtype="i8"), [-s for s, _ in scored]


def _search(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best vectors of a shard."""
    if not np.abs(query) @ np.maximum(np.abs(low), np.abs(high)) < 2.0 ** 53:
        return _exact(query, own, ids, vectors, k)
    # All sums are of whole numbers below 2^53, exact in any order.
    bound = np.maximum(query * low, query * high)
    order = np.argsort(-bound, kind="stable")
    open_bound = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)
    alive = np.flatnonzero(ids != own)
    score = np.zeros(len(alive))
    floor, at = -np.inf, 0
    # Essential: the dimensions that carry the first half of what can be reached.
    essential = max(STEP, int(np.argmax(open_bound <= open_bound[0] / 2)))
    while at < len(order) and len(alive):
        upto = min(len(order), at + (essential if at == 0 else STEP))
        dims = order[at:upto]
        score = score + vectors[np.ix_(alive, dims)] @ query[dims]
        at = upto
        if len(alive) > k:
            if at < len(order):
                # The leaders so far, scored in full, give a lower bound of the k-th best.
                lead = np.argpartition(-score, k - 1)[:k]
                full = vectors[alive[lead]] @ query
                floor = max(floor, full.min())
            stay = score + open_bound[at] >= floor
            alive, score = alive[stay], score[stay]
    top = _best(ids[alive], score, k)
    return ids[alive][top], score[top]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best vectors (all, if fewer).

    Both tables have ``vec_id, embedding``; other columns are not looked at. A
    vector never answers a query of the same id. Vectors that are null or hold a
    null or non-finite component take no part, neither do rows without an id;
    repeated rows are candidates each and ask once; shorter vectors count as filled with
    zeros. Scores are exact: where sums may pass 2^53 they are taken in integers of
    any size, and a score among the k best beyond 64 bits is an error. Empty tables give an empty result.

    A task holds one shard and one block of queries, whatever the tables' sizes.
    """
    ready = [df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), quantized(F.col("embedding")).alias("vector")) for df in (vectors, queries)]
    facts = ready[0].agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("w")).first()
    ready[1] = ready[1].dropDuplicates()
    n_queries = ready[1].count()
    if not facts["n"] or not n_queries:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = facts["w"]
    shards, blocks = -(-facts["n"] // SHARD), -(-n_queries // BLOCK)

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        # Rows are dealt evenly by a hash of the row, equal vectors included.
        place = F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(n_own))
        return df.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<bigint>")))
    held = dealt(ready[0], "shard", shards, "block", blocks)
    # Queries of one id with different vectors are told apart by a hash.
    asked = dealt(ready[1].withColumn("part", F.xxhash64("vector")), "block", blocks, "shard", shards)

    def run(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({"q": [], "part": [], "v": [], "score": []}, dtype="int64")
        ids, matrix = held["vec_id"].to_numpy(), _matrix(held["vector"], width)
        low, high = matrix.min(axis=0), matrix.max(axis=0)
        found: list[tuple] = []
        asking = _matrix(asked["vector"].map(lambda v: v[:width]), width)
        for own, part, query in zip(asked["vec_id"], asked["part"], asking):
            top, score = _search(query, own, ids, matrix, low, high, k)
            found += zip([own] * len(top), [part] * len(top), top, map(int, score))
        return pd.DataFrame(found, columns=["q", "part", "v", "score"]).astype("int64")

    parts = max(1, min(tasks(vectors), shards * blocks))
    held, asked = (d.repartition(parts, "shard", "block") for d in (held, asked))
    found = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(run, _OUT)
    rank = F.row_number().over(Window.partitionBy("q", "part").orderBy(F.desc("score"), "v"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("q").alias("query_id"), "rank", F.col("v").alias("vec_id"), "score")
