"""Reduction of vectors by principal components, and the table behind a scatter plot.

Neighbour embeddings (manifold methods) have no Spark form; PCA is offered as a different method, named so. Others can be
plugged in as a function over the collected, counted vectors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A plugged-in method runs on the driver and gets at most so many rows.
PLUGIN_ROWS = 200_000


def covariance(vectors: DataFrame, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """(mean, covariance): every task sums its rows; d + d^2 sums reach the driver."""
    d = vectors.select(F.max(F.size(vector))).first()[0] or 0

    def sums(batches):
        acc, n = np.zeros((d + 1, d)), 0
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[vector].to_numpy()).astype(float)
                acc[0] += x.sum(0)
                acc[1:] += x.T @ x
                n += len(x)
        yield pd.DataFrame({"i": np.arange(acc.size + 1), "v": np.append(acc.ravel(), n)})

    rows = vectors.select(vector).mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toPandas()["v"].to_numpy()
    if not len(rows) or rows[-1] == 0:
        return np.zeros(d), np.zeros((d, d))
    n, acc = rows[-1], rows[:-1].reshape(d + 1, d)
    mean = acc[0] / n
    return mean, acc[1:] / n - np.outer(mean, mean)


def reduce_dimensions(df: DataFrame, key: str, vector: str = "vector", components: int = 2, method: str | Callable[[np.ndarray, int], np.ndarray] = "pca") -> DataFrame:
    """(key, coords): ``components`` coordinates of every row with a vector. A component's largest loading is positive."""
    rows = df.select(key, vector).where(F.size(vector) > 0)
    kind = df.schema[key].dataType.simpleString()
    if method == "pca":
        mean, cov = covariance(rows, vector)
        values, axes = np.linalg.eigh(cov)
        axes = axes[:, np.argsort(-values)][:, :components]
        if axes.size:
            axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])

        def project(batches):
            for pdf in batches:
                x = np.stack(pdf[vector].to_numpy()).astype(float) if len(pdf) else np.zeros((0, len(mean)))
                yield pd.DataFrame({key: pdf[key], "coords": list((x - mean) @ axes)})

        return rows.mapInPandas(project, f"`{key}` {kind}, coords array<double>")
    if callable(method):
        if rows.count() > PLUGIN_ROWS:
            raise ValueError(f"a plugged-in method gets at most {PLUGIN_ROWS} rows")
        pdf = rows.orderBy(key).toPandas()
        coords = method(np.stack(pdf[vector].to_numpy()), components)
        return df.sparkSession.createDataFrame([(k, [float(z) for z in c]) for k, c in zip(pdf[key], coords)], f"`{key}` {kind}, coords array<double>")
    raise ValueError(f"unknown method: {method}")


def scatter(df: DataFrame, coords: DataFrame, key: str, color_by: str = "tradition") -> DataFrame:
    """(key, x, y[, z], colour column, those of text, tradition and title that exist)."""
    hover = [c for c in dict.fromkeys([color_by, "text", "tradition", "title"]) if c in df.columns]
    n = coords.select(F.max(F.size("coords"))).first()[0] or 2
    axes = [F.get("coords", F.lit(i)).alias(a) for i, a in enumerate("xyz"[: max(2, n)])]
    return df.select(key, *hover).join(coords.select(key, *axes), key)
