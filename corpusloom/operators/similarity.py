"""Vector search, group centroids and their similarities."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.vectors import dot, literal, norm, normalise

#: A query block is sent to every task; so many numbers at most are held in one.
QUERY_NUMBERS = 40_000_000


def semantic_search(vectors: DataFrame, query, key: str, vector: str = "vector", top_k: int = 10, where: dict[str, object] | None = None, scale: bool = False) -> DataFrame:
    """Top rows by the dot product with the query scaled to length one, with their rank; equal scores go by key.

    ``where`` holds equality filters, ANDed, which reach the scan. ``scale`` scales the stored vectors too (cosine);
    without it they count as they are. top_k = 0 gives no row; a zero query is an error."""
    q = np.asarray(query, dtype=float)
    if not np.linalg.norm(q) > 0:
        raise ValueError("a query vector of length zero has no direction")
    for c, v in (where or {}).items():
        vectors = vectors.where(F.col(c) == v)
    v = normalise(F.col(vector)) if scale else F.col(vector)
    scored = vectors.withColumn("score", dot(v, literal(q / np.linalg.norm(q)))).where("score is not null").drop(vector)
    best = scored.orderBy(F.desc("score"), key).limit(top_k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))  # top_k rows


def search_all(vectors: DataFrame, queries: DataFrame, key: str, vector: str = "vector", top_k: int = 10, query_key: str = "query_id") -> DataFrame:
    """(query_key, rank, key, score): the top rows of every query, cosine, all queries in one pass over the vectors.

    Queries (query_key, vector) go to the tasks in blocks of at most QUERY_NUMBERS numbers, after a count; each task keeps
    the top_k of its rows per query, so at most tasks x queries x top_k rows are shuffled. Zero and null vectors match nothing."""
    usable = queries.where(F.col(vector).isNotNull() & (norm(F.col(vector)) > 0))
    size = usable.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("d")).first()
    kinds = f"`{query_key}` {queries.schema[query_key].dataType.simpleString()}, `{key}` {vectors.schema[key].dataType.simpleString()}, score double"
    if not size["n"]:
        return vectors.sparkSession.createDataFrame([], kinds + ", rank int").select(query_key, "rank", key, "score")
    per_block = max(1, QUERY_NUMBERS // size["d"])
    blocks = -(-size["n"] // per_block)
    out = None
    for b in range(blocks):
        part = usable if blocks == 1 else usable.where(F.pmod(F.xxhash64(query_key), F.lit(blocks)) == b)
        rows = part.select(query_key, vector).toPandas()
        q = np.stack(rows[vector].to_numpy()).astype(float)
        q /= np.linalg.norm(q, axis=1, keepdims=True)
        shared = vectors.sparkSession.sparkContext.broadcast((rows[query_key].to_numpy(), q))

        def score(batches, shared=shared):
            ids, q = shared.value
            held: pd.DataFrame | None = None
            for pdf in batches:
                if not len(pdf):
                    continue
                x = np.stack(pdf[vector].to_numpy()).astype(float)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                s = q @ x.T
                k = min(top_k, s.shape[1])
                # all rows that tie with the k-th best stay until the end, where the key decides
                cut = -np.partition(-s, k - 1, axis=1)[:, k - 1 : k] if k else np.full((len(q), 1), np.inf)
                i, j = np.nonzero(s >= cut - 1e-12)
                new = pd.DataFrame({query_key: ids[i], key: pdf[key].to_numpy()[j], "score": s[i, j]})
                held = new if held is None else pd.concat([held, new])
                if len(held) > 4 * len(ids) * top_k + 10_000:
                    held = held.sort_values(["score", key], ascending=[False, True]).groupby(query_key).head(top_k)
            if held is not None:
                yield held.sort_values(["score", key], ascending=[False, True]).groupby(query_key).head(top_k)

        good = vectors.where(F.col(vector).isNotNull() & (norm(F.col(vector)) > 0)).select(key, vector)
        found = good.mapInPandas(score, kinds)
        out = found if out is None else out.unionByName(found)
    rank = F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), key))
    return out.withColumn("rank", rank).where(F.col("rank") <= top_k).select(query_key, "rank", key, "score")


def centroids(vectors: DataFrame, group: str, vector: str = "vector") -> DataFrame:
    """(group, dim, value): mean vector of each group, scaled to length one. Sums combine before the shuffle."""
    each = vectors.where(F.col(vector).isNotNull() & F.col(group).isNotNull()).select(F.col(group), F.posexplode(vector).alias("dim", "x"))
    mean = each.groupBy(group, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    length = mean.groupBy(group).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("l"))
    return mean.join(length, group).where("l > 0").select(group, "dim", (F.col("m") / F.col("l")).alias("value"))


def similarity_matrix(vectors: DataFrame, group: str, vector: str = "vector") -> DataFrame:
    """(a, b, sim) for all pairs of groups: an equi-join of the centroids on their dimension, summed."""
    c = centroids(vectors, group, vector)
    a, b = c.select(F.col(group).alias("a"), "dim", F.col("value").alias("x")), c.select(F.col(group).alias("b"), "dim", F.col("value").alias("y"))
    return a.join(b, "dim").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("sim"))


def heatmap(matrix: DataFrame, digits: int = 3) -> DataFrame:
    return matrix.select("a", "b", F.round("sim", digits).alias("value"))


def matrix_table(matrix: DataFrame, digits: int = 3) -> DataFrame:
    """The dense view for printing; one column per group."""
    return matrix.groupBy("a").pivot("b").agg(F.round(F.first("sim"), digits)).orderBy("a")
