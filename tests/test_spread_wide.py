"""Principal components of wide vectors against a decomposition of the whole matrix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from inkfold.operators import similarity


def variances(df):
    rows = df.groupBy("label").agg(F.var_pop("px").alias("x"), F.var_pop("py").alias("y")).collect()
    return {r.label: (r.x, r.y) for r in rows}


def test_same_variances_at_64_columns(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").withColumn("label", F.when(F.col("label") != 2, F.col("label")))
    want, got = (variances(f(df, "label", "embedding")) for f in (similarity.label_spread, similarity.label_spread_wide))
    assert got.keys() == want.keys() and None in got
    for label, pair in want.items():
        assert got[label] == pytest.approx(pair, rel=1e-6)


def test_wide_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    width, rows = 4096, []
    for label in ("a", "b", "c"):
        basis = np.linalg.qr(rng.normal(size=(width, 6)))[0] * np.array([9, 7, 5, 3, 2, 1])
        rows += [(label, [float(v) for v in x]) for x in 3 + rng.normal(size=(60, 6)) @ basis.T + 0.02 * rng.normal(size=(60, width))]
    rows += [("one", [1.0, 2.0, 3.0]), ("flat", [1.0, 1.0]), ("flat", [1.0, 1.0]), ("none", None)]
    df = spark.createDataFrame(rows, "label string, vec array<double>").repartition(5)
    # A group of labels at a time.
    monkeypatch.setattr(similarity, "SPREAD_BYTES", 1 << 22)
    found = similarity.label_spread_wide(df)
    assert found.count() == 183
    got = variances(found)
    for label in ("a", "b", "c"):
        x = np.array([v for name, v in rows if name == label])
        want = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)[:2] ** 2 / len(x)
        assert got[label] == pytest.approx(tuple(want), rel=1e-6)
    assert got["one"] == got["flat"] == (0.0, 0.0)
