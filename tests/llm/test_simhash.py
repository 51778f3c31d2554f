"""Golay keys, fingerprints, links and components against plain Python."""

import random
from collections import defaultdict
from contextlib import contextmanager

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.llm import common, queries, simhash
from inkfold.llm import components as component_rounds
from inkfold.llm.components import components


def plain_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def plain_groups(fps, radius=3):
    """fps: (id, fingerprint); id -> smallest id reachable."""
    distinct = sorted({f for _, f in fps})
    pairs = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= radius]
    root, least = plain_components(distinct, pairs), {}
    for i, f in fps:
        least[root[f]] = min(i, least.get(root[f], i))
    return {i: least[root[f]] for i, f in fps}


def test_golay_code_is_perfect():
    golay = simhash.Golay()
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 20_000)
    code = words ^ golay.error[simhash._remainder(words)]
    assert (simhash._remainder(code) == 0).all()
    assert np.bitwise_count(words ^ code).max() == 3
    # One or six codewords are nearest to a word and its neighbours.
    at, _ = golay.keys(words)
    assert set(np.bincount(at)) == {1, 6}


def test_fingerprints_within_three_bits_share_a_key():
    golay, rng = simhash.Golay(), random.Random(3)
    for _ in range(1500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        fps, keys = simhash.key_rows(np.array([a, b], dtype="u8"), golay)
        assert set(keys[fps == a]) & set(keys[fps == b])


@pytest.mark.parametrize("text", ["", None, "one", "One TWO", "a b c d e f g", "É é\x0b\x1c x y", "x " * 5000, "퟿ \U0001f600 z"])
@pytest.mark.parametrize("width", [3, 5])
def test_fingerprint_matches_plain_python(text, width, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint((text or "").encode().lower().split(), width) == plain_fingerprint(text, width)


def test_query_on_whole_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    fps = [(i, plain_fingerprint(t, 3)) for i, t in texts]
    want = plain_groups(fps)
    rows = queries.REGISTRY["op2_simhash"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((i, f"{f:016x}", want[i]) for i, f in fps)


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_dense_and_sparse_groups(spark, block):
    rng = random.Random(block)
    fps = set()
    for _ in range(30):
        center = rng.getrandbits(64)
        for _ in range(40):
            near = center
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                near ^= 1 << bit
            fps.add(near)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    found = simhash.links(simhash.fingerprint_keys(distinct), block=block).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() for r in found)
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    want = plain_components(signed, pairs)
    got = plain_components(signed, [(r.a, r.b) for r in found])
    groups = lambda roots: sorted(sorted(g) for g in _by_root(roots).values())
    assert groups(got) == groups(want)


def _by_root(roots):
    out = defaultdict(list)
    for k, v in roots.items():
        out[v].append(k)
    return out


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (-5, 3), (3, -5)]
    pairs += [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)]
    rng.shuffle(pairs)
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert found == plain_components(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@contextmanager
def settings(spark, own):
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def executed_plan(df):
    """The joins as they ran, after what Spark measured on the way."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


def test_keys_taken_for_few_are_not_broadcast(spark, tmp_path):
    """24 keys of a fingerprint pass for one row: 2,000 stored ones count as 32 kB, their keys are 1 MB."""
    rng = random.Random(8)
    spark.createDataFrame([(rng.getrandbits(63),) for _ in range(2000)], "fp bigint").write.parquet(str(tmp_path / "fps"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "64k"}):
        distinct = spark.read.parquet(str(tmp_path / "fps")).groupBy("fp").agg(F.count("*").alias("n"))
        assert "Broadcast" not in executed_plan(simhash.links(simhash.fingerprint_keys(distinct)))


def test_links_of_a_hub_are_dealt_anew(spark):
    """A node with very many links is no single task's, though the least neighbours come dealt by node."""
    parts = "spark.sql.adaptive."
    small = {f"{parts}skewJoin.skewedPartitionThresholdInBytes": "16k", f"{parts}advisoryPartitionSizeInBytes": "16k", f"{parts}coalescePartitions.enabled": "false"}
    u = F.when(F.col("id") < 39_000, -1).otherwise(F.col("id"))
    pairs = spark.range(40_000).select(u.alias("u"), (F.col("id") * 7 % 40_000).alias("v"))
    with settings(spark, small):
        for large in (True, False):
            star = component_rounds._star(pairs, large)
            assert "SortMergeJoin(skew=true)" in executed_plan(star)


def test_no_join_on_the_way_is_broadcast(spark, monkeypatch):
    plans = {}

    def stored(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return common.stored(df, name)
    monkeypatch.setattr(simhash, "stored", stored)
    monkeypatch.setattr(component_rounds, "stored", stored)
    texts = [f"text {i // 2} of several words" for i in range(40)]
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 40
    docs = spark.createDataFrame(enumerate(texts + [words + "x", words + "y", words + "z"]), "doc_id bigint, text string")
    found = simhash.near_duplicates(docs)
    plans["result"] = [executed_plan(found)]
    assert {"links", "fingerprint-roots", "result"} <= set(plans) and len(plans["links"]) > 1
    assert not [name for name, some in plans.items() if any("Broadcast" in p for p in some)]


def test_edges(spark):
    long = "w " * 70_000
    rows = [(1, None, "a"), (2, "", "b"), (5, " \n", "c"), (3, long, "d"), (3, long, "d"), (None, long, "e"), (9, "other words here now", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string").withColumn("component_id", F.lit("x"))
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in found) == [(0, 3), (1, 1), (2, 1), (3, 3), (3, 3), (5, 1), (9, 9)]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 9]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_per_group(docs.limit(0)).count() == 0
