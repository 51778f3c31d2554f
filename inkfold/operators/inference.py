"""Caller-supplied models, run in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_infer(df: DataFrame, make_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                schema: str) -> DataFrame:
    """Run a model over rows: ``make_model`` is called once per task and returns
    a function from one batch of rows to result rows. Settings are columns."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for batch in batches:
            yield model(batch)

    return df.mapInPandas(run, schema)


def array_model(make_model: Callable[[], Callable[..., np.ndarray]], returns: T.DataType, batch_size: int = 1024,
                shapes: list[list[int] | None] | None = None) -> Callable[..., Column]:
    """A column function around a model of arrays.

    ``make_model`` is called once per Python worker, however many tasks the worker
    runs, and returns a function from numpy arrays (one per column, ``batch_size`` rows; array columns have the
    given ``shapes``) to an array of results. Settings are columns among others.
    """
    return predict_batch_udf(make_model, return_type=returns, batch_size=batch_size, input_tensor_shapes=shapes)


def infer_sweep(df: DataFrame, model: Callable[..., Column], inputs: list[str], settings: dict[str, dict[str, float]],
                name: str = "result") -> DataFrame:
    """Every row under every setting, with one model: adds ``config`` and the result.

    The values of a setting are columns handed to the model behind its inputs, so
    rows of several settings share a batch. A null input has a null result.
    """
    keys = sorted({k for values in settings.values() for k in values})
    listed = F.array(*[F.struct(F.lit(c).alias("config"), *[F.lit(float(v[k])).alias(f"_{k}") for k in keys]) for c, v in settings.items()])
    rows = df.select("*", F.inline(listed))
    known = rows
    for c in inputs:
        known = known.where(F.col(c).isNotNull())
    found = known.withColumn(name, model(*[F.col(c) for c in inputs], *[F.col(f"_{k}") for k in keys]))
    gaps = rows.where(" OR ".join(f"`{c}` IS NULL" for c in inputs))
    return found.unionByName(gaps, allowMissingColumns=True).drop(*[f"_{k}" for k in keys])
