"""Connected components of an edge table by alternating least-neighbour steps and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import materialise, small


def contracted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((node, label), (u, v)): every node labelled by the least of itself and its neighbours, and the edges between different labels.

    A label is joined to its node, so the components of the labels are those of the nodes; near-cliques shrink to a point, and the
    rounds that follow meet few edges."""
    ends = edges.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("other")))
    label = materialise(ends.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")))
    near = small(label)
    a, b = near.select(F.col("node").alias("src"), F.col("label").alias("x")), near.select(F.col("node").alias("dst"), F.col("label").alias("y"))
    between = edges.select("src", "dst").join(a, "src").join(b, "dst").where("x <> y")
    return label, materialise(between.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (src, dst); the component is its least node.

    After a contraction each round links every neighbour of a node to the least of them (large star, then small star), so the number
    of rounds grows with the logarithm of the longest path. Every round writes a checkpoint. No neighbourhood is gathered in one row."""
    label, pairs = contracted(edges)
    state = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    old = state(pairs)
    for _ in range(rounds if old["n"] else 0):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        pairs = materialise(small.distinct())
        new = state(pairs)
        if new == old:
            break
        old = new
    else:
        if old["n"]:
            raise RuntimeError("components did not settle")
    return label.join(pairs.select(F.col("u").alias("label"), F.col("v").alias("component")), "label", "left").select("node", F.coalesce("component", "label").alias("component"))
