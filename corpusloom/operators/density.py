"""Hierarchical density clustering (mutual reachability, minimum spanning tree, condensed tree, excess of mass).

Core distances come from a blocked pass of the vectors against themselves; the spanning tree is grown by Boruvka rounds, each of
which finds the nearest outside neighbour of every point in blocked passes and merges components. The tree (n - 1 edges)
is condensed on the driver, so the number of points is checked against ``most`` first. Blocks, not pairs, move between tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The blocked passes hold all vectors in every task and the tree on the driver; more points are refused.
MOST_POINTS = 200_000


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def find(self, a: int) -> int:
        p = self.parent
        while p[a] != a:
            p[a] = p[p[a]]
            a = p[a]
        return int(a)

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _blocks(spark, n: int, size: int):
    return spark.createDataFrame([(a, min(n, a + size)) for a in range(0, n, size)], "a int, b int").repartition(max(1, -(-n // size)))


def core_distances(spark, shared, n: int, k: int, size: int = 1024) -> np.ndarray:
    def run(batches):
        x = shared.value
        sq = (x * x).sum(1)
        for pdf in batches:
            for a, b in zip(pdf["a"], pdf["b"]):
                d = np.sqrt(np.maximum(sq[a:b, None] + sq[None] - 2 * x[a:b] @ x.T, 0))
                kk = min(k, n) - 1
                yield pd.DataFrame({"i": np.arange(a, b), "c": np.partition(d, kk, axis=1)[:, kk]})

    rows = _blocks(spark, n, size).mapInPandas(run, "i int, c double").toPandas()
    out = np.zeros(n)
    out[rows["i"].to_numpy()] = rows["c"].to_numpy()
    return out


def spanning_tree(spark, shared, core: np.ndarray, size: int = 1024) -> np.ndarray:
    """Rows (weight, i, j) of the minimum spanning tree of mutual reachability, sorted."""
    n = len(core)
    forest, edges = _Forest(n), []
    while len(edges) < n - 1:
        comp = np.array([forest.find(i) for i in range(n)])
        state = spark.sparkContext.broadcast((comp, core))

        def nearest(batches, state=state):
            x = shared.value
            comp, core = state.value
            sq = (x * x).sum(1)
            for pdf in batches:
                for a, b in zip(pdf["a"], pdf["b"]):
                    d = np.sqrt(np.maximum(sq[a:b, None] + sq[None] - 2 * x[a:b] @ x.T, 0))
                    np.maximum(d, core[a:b, None], out=d)
                    np.maximum(d, core[None], out=d)
                    d[comp[a:b, None] == comp[None]] = np.inf
                    j = d.argmin(1)
                    yield pd.DataFrame({"c": comp[a:b], "w": d[np.arange(b - a), j], "i": np.arange(a, b), "j": j})

        best = _blocks(spark, n, size).mapInPandas(nearest, "c int, w double, i int, j int").groupBy("c").agg(F.min(F.struct("w", "i", "j")).alias("m")).select("m.*").toPandas()
        grown = False
        for w, i, j in sorted(zip(best["w"], best["i"], best["j"])):
            if np.isfinite(w) and forest.union(int(i), int(j)):
                edges.append((w, i, j))
                grown = True
        state.unpersist()
        if not grown:
            break
    return np.array(sorted(edges)).reshape(-1, 3)


def condense(tree: np.ndarray, n: int, least: int) -> np.ndarray:
    """Cluster of every point by excess of mass over the condensed tree; -1 is noise."""
    label = np.full(n, -1)
    if n < 2 or not len(tree):
        return label
    # single linkage
    forest = {i: i for i in range(n)}
    up = np.arange(2 * n - 1)

    def find(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    left, right, dist, size = {}, {}, {}, {i: 1 for i in forest}
    for t, (w, i, j) in enumerate(tree):
        a, b, new = find(int(i)), find(int(j)), n + t
        left[new], right[new], dist[new] = a, b, w
        size[new] = size[a] + size[b]
        up[a] = up[b] = new
    roots = sorted({find(i) for i in range(n)})

    def leaves(node):
        out, stack = [], [node]
        while stack:
            x = stack.pop()
            if x < n:
                out.append(x)
            else:
                stack += [left[x], right[x]]
        return out

    birth, stability, children, points, order = {}, {}, {}, {}, []
    stack = [(r, r, 0.0) for r in roots if size[r] >= least]
    for r, _, b in stack:
        birth[r], stability[r], children[r], points[r] = b, 0.0, [], []
        order.append(r)
    while stack:
        node, cluster, _ = stack.pop()
        if node < n:
            points[cluster].append(node)
            continue
        lam = 1.0 / max(dist[node], 1e-12)
        a, b = left[node], right[node]
        if size[a] >= least and size[b] >= least:
            for c in (a, b):
                birth[c], stability[c], children[c], points[c] = lam, 0.0, [], []
                children[cluster].append(c)
                order.append(c)
                stack.append((c, c, lam))
            stability[cluster] += (size[a] + size[b]) * (lam - birth[cluster])
        else:
            for c in (a, b):
                if size[c] >= least:
                    stack.append((c, cluster, lam))
                else:
                    stability[cluster] += size[c] * (lam - birth[cluster])
                    points[cluster] += leaves(c)
    chosen = set()
    value = {}
    for c in reversed(order):
        below = sum(value[k] for k in children[c])
        if c in roots and children[c]:
            value[c] = below  # the whole is no cluster if it splits
        elif stability[c] >= below:
            value[c] = stability[c]
            chosen.add(c)
        else:
            value[c] = below
    number = 0
    stack = list(reversed([c for c in order if c in roots]))
    while stack:
        c = stack.pop()
        if c in chosen:
            inside = [c]
            while inside:
                x = inside.pop()
                label[points[x]] = number
                inside += children[x]
            number += 1
        else:
            stack += reversed(children[c])
    return label


def density_clusters(df: DataFrame, key: str, vector: str = "vector", min_cluster_size: int = 10, min_samples: int | None = None) -> DataFrame:
    """(key, cluster): Euclidean; -1 is noise; clusters are numbered along the tree. Rows without a vector leave."""
    spark = df.sparkSession
    rows = df.select(key, vector).where(F.size(vector) > 0).orderBy(key)
    kind = df.schema[key].dataType.simpleString()
    n = rows.count()
    if n > MOST_POINTS:
        raise ValueError(f"{n} points; at most {MOST_POINTS} are clustered, reduce or sample them first")
    if n == 0:
        return spark.createDataFrame([], f"`{key}` {kind}, cluster int")
    pdf = rows.toPandas()
    x = np.stack(pdf[vector].to_numpy()).astype(float)
    shared = spark.sparkContext.broadcast(x)
    core = core_distances(spark, shared, n, min_samples or min_cluster_size)
    label = condense(spanning_tree(spark, shared, core), n, min_cluster_size)
    return spark.createDataFrame(pd.DataFrame({key: pdf[key], "cluster": label.astype("int32")}), f"`{key}` {kind}, cluster int")
