"""Problem 6: clusters of chunks by Markov clustering of a similarity graph of their vectors.

Graph: equal vectors are collapsed; the rest are hashed by cross-polytopes into buckets of several tables, whose number follows
from the wanted recall at the very threshold; inside a bucket all cosines are computed block by block. In a crowded bucket a vector
keeps its 40 strongest links for the flow and a few others, which lead to the common check below. Markov clustering alternates
squaring of the column-stochastic flow matrix, inflation and pruning of small entries until the flow settles.
The matrix is block-diagonal over the connected components of the graph, so components up to ``block`` nodes are squared as
dense blocks, many per task; larger ones by the same steps as joins of the sparse entries across the cluster. Attractor rows name the clusters.
At last every cluster is checked against the vectors: it is divided into sets of members that are all similar to each other, and
sets of different Markov clusters with a link between them are checked together if their means allow it.

Defined cases: null vectors, all-zero vectors and vectors of another length than most are noise; repeated rows of a chunk count
once; chunks without a vector are noise; clusters with fewer than ``least`` chunks are noise; ties between attractors go to
the smaller node; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.base import free_shuffles, iter_groups, materialise, parallelism, small
from corpusloom.llm.components import components

#: What the rounding of vectors to bytes may change in a cosine.
SLACK = 0.015


#: A bucket holds at most about so many unrelated vectors.
BUCKET = 1024
#: Rows of a bucket that one task compares with each other; larger buckets are divided into cells of two blocks of about so many.
BLOCK = 4096


class Directions:
    """Cross-polytope hashing: a hash is the axis of a random rotation next to the vector, with its sign.

    ``parts`` rotations into so many dimensions each make a code of about log2(rows / BUCKET) bits; ``tables`` codes are made, so that
    two vectors at ``cosine`` share one with a probability of ``recall`` at least. The chance of one code is measured on random
    pairs at that cosine."""

    def __init__(self, rows: int, dims: int, cosine: float, recall: float = 0.95, seed: int = 61) -> None:
        rng = np.random.default_rng(seed)
        bits = max(1, math.ceil(math.log2(max(2, rows) / BUCKET)))
        full = max(1, int(math.log2(2 * dims)))
        self.parts = [full] * (bits // full) + [bits % full] * (bits % full > 0)
        x = rng.standard_normal((20_000, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = rng.standard_normal(x.shape)
        y -= (y * x).sum(1, keepdims=True) * x
        y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
        chance = {p: max(1e-3, float((self.axis(x, r) == self.axis(y, r)).mean())) for p in set(self.parts) for r in [rng.standard_normal((dims, 1 << p >> 1))]}
        p = math.prod(chance[q] for q in self.parts)
        self.tables = 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p))
        self.rotations = [[rng.standard_normal((dims, 1 << q >> 1)).astype(np.float32) for q in self.parts] for _ in range(self.tables)]

    @staticmethod
    def axis(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
        y = x @ rotation
        k = np.abs(y).argmax(1)
        return 2 * k + (y[np.arange(len(y)), k] > 0)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables): the bucket of each row of unit vectors in each table."""
        out = np.empty((len(x), self.tables), np.int64)
        for t, parts in enumerate(self.rotations):
            code = np.full(len(x), t, np.int64)
            for q, r in zip(self.parts, parts):
                code = (code << q) + self.axis(x, r)
            out[:, t] = code
        return out


def unit_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, node, v): the rows with a usable vector, scaled to length one; equal vectors share a node. Repeated rows stay."""
    size = vectors.where(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = size["d"] if size else 0
    kind = vectors.schema[key].dataType.simpleString()

    def units(batches):
        for pdf in batches:
            x = np.stack(pdf[vector].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 1))
            n = np.sqrt((x * x).sum(1))
            ok = np.isfinite(n) & (n > 0)
            v = (x[ok] / n[ok, None]).astype(np.float32)
            node = np.array([xxhash.xxh64_intdigest(r.tobytes()) for r in np.round(v, 6) + np.float32(0)], np.uint64).view(np.int64)
            yield pd.DataFrame({key: pdf[key].to_numpy()[ok], "node": node, "v": list(v)})

    whole = F.col(key).isNotNull() & (F.size(vector) == dims) & ~F.exists(vector, lambda x: x.isNull())
    return vectors.select(key, vector).where(whole).mapInPandas(units, f"`{key}` {kind}, node long, v array<float>")


def _bucket_arrays(batches):
    """(cells, ids, unit vectors, sides) of whole cells from the sorted rows of a partition."""
    rest: tuple | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        x = np.frombuffer(b"".join(pdf["q"]), np.int8).reshape(len(pdf), -1).astype(np.float32)
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
        now = (pdf["cell"].to_numpy(), pdf["node"].to_numpy(), x, pdf["side"].to_numpy())
        if rest is not None:
            now = tuple(np.concatenate(p) for p in zip(rest, now))
        last = int(np.searchsorted(now[0], now[0][-1]))  # the last cell may go on in the next batch
        if last:
            yield tuple(p[:last] for p in now)
        rest = tuple(p[last:] for p in now)
    if rest is not None:
        yield rest


def strongest_links(x: np.ndarray, least: float, strongest: int, block: int, others: int = 3, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine, strong) of the pairs of rows of unit vectors at ``least`` or more; a row with more than ``strongest`` such
    partners keeps the strongest (a pair stays if it is among those of either row) and, as links that are not strong, ``others``
    more, the first of its partners in random orders of all rows. With ``side`` only rows of different sides are paired. Blocks bound
    the memory."""
    n = len(x)
    if n <= block:
        s = x @ x.T
        if side is not None:
            s[side[:, None] == side[None]] = -1
        i, j = np.nonzero(s >= least)
        keep = i < j
        if np.bincount(i, minlength=n).max(initial=0) <= strongest + 1:
            i, j = i[keep], j[keep]
            return i, j, s[i, j], np.ones(len(i), bool)
    rng = np.random.default_rng(n)
    orders = [rng.permutation(n) for _ in range(others)]
    out: list[tuple] = []
    for a in range(0, n, block):
        rows = min(block, n - a)
        best_s, best_j = np.zeros((rows, 0), np.float32), np.zeros((rows, 0), np.int64)
        first = np.full((others, rows), n)
        first_s, first_j = np.zeros((others, rows), np.float32), np.zeros((others, rows), np.int64)
        for b in range(0, n, block):
            s = x[a : a + block] @ x[b : b + block].T
            if a == b:
                np.fill_diagonal(s, -1)
            if side is not None:
                s[side[a : a + block, None] == side[None, b : b + block]] = -1
            m = min(strongest, s.shape[1])
            top = np.argpartition(-s, m - 1, axis=1)[:, :m]
            cat_s, cat_j = np.concatenate([best_s, np.take_along_axis(s, top, 1)], 1), np.concatenate([best_j, top + b], 1)
            m = min(strongest, cat_s.shape[1])
            keep = np.argpartition(-cat_s, m - 1, axis=1)[:, :m]
            best_s, best_j = np.take_along_axis(cat_s, keep, 1), np.take_along_axis(cat_j, keep, 1)
            ok, all_ = s >= least, np.arange(rows)
            for k, order in enumerate(orders):
                place = np.where(ok, order[None, b : b + block], n)
                j = place.argmin(1)
                new = place[all_, j] < first[k]
                first[k, new], first_s[k, new], first_j[k, new] = place[all_, j][new], s[all_, j][new], j[new] + b
        i, k = np.nonzero(best_s >= least)
        out.append((i + a, best_j[i, k], best_s[i, k], np.ones(len(i), bool)))
        k, i = np.nonzero(first < n)
        out.append((i + a, first_j[k, i], first_s[k, i], np.zeros(len(i), bool)))
    return tuple(np.concatenate(p) for p in zip(*out))


def _frame(src: list, dst: list, w: list, strong: list) -> pd.DataFrame:
    """Links of many buckets; a pair met in several is kept once, as strong if it is so in one."""
    out = pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst), "w": np.concatenate(w).astype(np.float64), "strong": np.concatenate(strong)})
    return out.sort_values("strong", ascending=False, kind="stable").drop_duplicates(["src", "dst"])


def in_cells(buckets: DataFrame, most: int) -> DataFrame:
    """(cell, side, node, q) of (bucket, node, q): a bucket of more than ``most`` rows is divided into blocks, and every two blocks meet in
    a cell of their own (as its two sides), so that no task meets a whole hot bucket and no pair is lost."""
    sizes = materialise(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > most))
    plain = lambda df: df.select(F.col("bucket").alias("cell"), F.lit(0).alias("side"), "node", "q")
    hot = sizes.count()
    if not hot:
        return plain(buckets)
    sizes = F.broadcast(sizes) if hot <= 100_000 else sizes
    own, j = F.col("own"), F.col("j")
    wide = buckets.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / most).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wide = wide.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = wide.select(F.xxhash64("bucket", F.least(own, j), F.greatest(own, j)).alias("cell"), F.when(own == j, 0).when(own < j, 1).otherwise(2).alias("side"), "node", "q")
    return plain(buckets.join(sizes, "bucket", "left_anti")).unionByName(cells)


def similar_pairs(nodes: DataFrame, cosine: float, strongest: int = 40, block: int = 2048, total: int | None = None, recall: float = 0.95, most: int = BLOCK) -> DataFrame:
    """(src, dst, w, strong) with src < dst: links found in shared buckets, each with a probability of ``recall`` at the threshold and more
    above; a vector with more than ``strongest`` links in a bucket keeps those and a few others, which are not strong."""
    n = nodes.count() if total is None else total
    first = nodes.select(F.size("v").alias("d")).first()
    directions = Directions(n, first["d"] if first else 1, cosine, recall)
    spark = nodes.sparkSession

    def buckets(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["v"].to_numpy()).astype(np.float32)
            code = directions.codes(x)
            packed = [r.tobytes() for r in np.clip(np.rint(x * 127), -127, 127).astype(np.int8)]
            ids = pdf["node"].to_numpy()
            for t in range(code.shape[1]):
                yield pd.DataFrame({"bucket": code[:, t], "node": ids, "q": packed})

    def links(batches):
        src, dst, w, strong, held = [], [], [], [], 0
        for codes, ids, x, sides in _bucket_arrays(batches):
            cuts = np.flatnonzero(codes[1:] != codes[:-1]) + 1
            for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(codes)).tolist()):
                if b - a < 2:
                    continue
                i, j, s, kind = strongest_links(x[a:b], cosine - SLACK, strongest, block, side=sides[a:b] if sides[a] else None)
                if len(i):
                    u, v = ids[a:b][i], ids[a:b][j]
                    src.append(np.minimum(u, v))
                    dst.append(np.maximum(u, v))
                    w.append(s)
                    strong.append(kind)
                    held += len(i)
            if held > 1_000_000:
                yield _frame(src, dst, w, strong)
                src, dst, w, strong, held = [], [], [], [], 0
        if held:
            yield _frame(src, dst, w, strong)

    rows = nodes.select("node", "v").mapInPandas(buckets, "bucket long, node long, q binary")
    # as many tasks as hold some hundred thousand bucket rows each
    parts = max(parallelism(spark), math.ceil(n * directions.tables / 400_000))
    found = in_cells(rows, most).repartition(parts, "cell").sortWithinPartitions("cell").mapInPandas(links, "src long, dst long, w double, strong boolean")
    found = materialise(found.groupBy("src", "dst").agg(F.max("w").alias("w"), F.max("strong").alias("strong")))
    free_shuffles(spark)
    return exact_links(found, nodes, cosine)


def exact_links(found: DataFrame, nodes: DataFrame, cosine: float, slack: float = SLACK) -> DataFrame:
    """``found`` without links of less than ``cosine``: those that the rounding leaves in doubt are looked up in the vectors."""
    unsure = found.where(F.col("w") < cosine + slack)
    if unsure.isEmpty():
        return found
    ends = materialise(unsure.select(F.explode(F.array("src", "dst")).alias("node")).distinct())
    held = nodes.select("node", "v").join(small(ends), "node", "left_semi")
    a, b = held.select(F.col("node").alias("src"), F.col("v").alias("a")), held.select(F.col("node").alias("dst"), F.col("v").alias("b"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    told = unsure.join(a, "src").join(b, "dst").withColumn("w", dot).where(F.col("w") >= cosine - 1e-6).select(found.columns)
    return materialise(found.where(F.col("w") >= cosine + slack).unionByName(told))


#: Rounds of squaring at most, and the largest move of an entry at which the flow has settled.
ROUNDS, SETTLED = 40, 1e-5


def mcl_block(n: int, i: np.ndarray, j: np.ndarray, w: np.ndarray, inflation: float, prune: float) -> tuple[np.ndarray, np.ndarray]:
    """(attractor, flow into it) of the n nodes of one component by dense squaring."""
    m = np.zeros((n, n))
    m[i, j] = w
    m[j, i] = w
    m[np.arange(n), np.arange(n)] = 1.0
    m /= m.sum(0)
    for _ in range(ROUNDS):
        new = m @ m
        np.power(new, inflation, out=new)
        new /= new.sum(0)
        new[(new < prune) & (new < new.max(0))] = 0
        new /= new.sum(0)
        done = np.abs(new - m).max() < SETTLED
        m = new
        if done:
            break
    best = m.max(0)
    at = (m >= best - 1e-9).argmax(0)
    return at, m[at, np.arange(n)]


def mcl_sparse(entries: DataFrame, inflation: float, prune: float) -> DataFrame:
    """(node, attractor, flow) for components too large for a block: the same steps, by joins of the sparse entries.

    Small-entry pruning leaves at most 1 / prune entries of a column. Partial sums are combined before each shuffle."""

    def normal(df: DataFrame) -> DataFrame:
        return df.join(df.groupBy("j").agg(F.sum("w").alias("t"), F.max("w").alias("best")), "j").select("i", "j", (F.col("w") / F.col("t")).alias("w"), (F.col("best") / F.col("t")).alias("best"))

    loops = entries.select(F.col("j").alias("i"), "j").distinct().withColumn("w", F.lit(1.0))
    m = materialise(normal(entries.select("i", "j", "w").unionByName(loops)).drop("best"))
    for _ in range(ROUNDS):
        left = m.select("i", F.col("j").alias("k"), F.col("w").alias("a"))
        right = m.select(F.col("i").alias("k"), "j", F.col("w").alias("b"))
        squared = left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("w"))
        grown = normal(squared.withColumn("w", F.pow("w", F.lit(inflation))))
        new = materialise(normal(grown.where((F.col("w") >= prune) | (F.col("w") >= F.col("best"))).drop("best")).drop("best"))
        move = new.join(m.withColumnRenamed("w", "old"), ["i", "j"], "full").agg(F.max(F.abs(F.coalesce("w", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0]
        m = new
        if move is None or move < SETTLED:
            break
    near = m.join(m.groupBy("j").agg(F.max("w").alias("best")), "j").where(F.col("w") >= F.col("best") - 1e-9)
    return near.groupBy("j").agg(F.min("i").alias("attractor"), F.max("best").alias("flow")).select(F.col("j").alias("node"), "attractor", "flow")


def markov_clusters(edges: DataFrame, inflation: float = 2.0, prune: float = 1e-4, block: int = 1500) -> DataFrame:
    """(node, cluster, flow): the attractor of every node of the graph, and its flow there."""
    spark = edges.sparkSession
    comp = components(edges.select("src", "dst"))
    sizes = comp.groupBy("component").agg(F.count("*").alias("size"))
    comp = materialise(comp.join(sizes, "component"))
    free_shuffles(spark)
    placed = edges.join(small(comp).withColumnRenamed("node", "src"), "src")

    def squares(batches):
        for pdf in iter_groups(batches, "component"):
            ids, inv = np.unique(np.concatenate([pdf["src"].to_numpy(), pdf["dst"].to_numpy()]), return_inverse=True)
            h = len(pdf)
            at, flow = mcl_block(len(ids), inv[:h], inv[h:], pdf["w"].to_numpy(), inflation, prune)
            yield pd.DataFrame({"node": ids, "cluster": ids[at], "flow": flow})

    dense = placed.where(F.col("size") <= block).select("component", "src", "dst", "w").repartition(parallelism(spark), "component").sortWithinPartitions("component")
    out = dense.mapInPandas(squares, "node long, cluster long, flow double")
    large = placed.where(F.col("size") > block)
    if not large.isEmpty():
        both = large.select(F.col("src").alias("i"), F.col("dst").alias("j"), "w").unionByName(large.select(F.col("dst").alias("i"), F.col("src").alias("j"), "w"))
        out = out.unionByName(mcl_sparse(both, inflation, prune).withColumnRenamed("attractor", "cluster"))
    return out


def _degrees(x: np.ndarray, cosine: float, block: int = 1024) -> np.ndarray:
    """How many rows of unit vectors each is similar to, itself included; blocks bound the memory.

    Rows within half the angle of the mean are similar to each other, so only the others are compared with all."""
    mean = x.mean(0)
    norm = np.linalg.norm(mean)
    core = x @ (mean / norm) >= math.cos(math.acos(min(1.0, cosine)) / 2) if norm > 0 else np.zeros(len(x), bool)
    out = np.flatnonzero(~core)
    deg = np.where(core, core.sum(), 0)
    for a in range(0, len(out), block):
        ok = x[out[a : a + block]] @ x.T >= cosine - 1e-6
        deg[out[a : a + block]] = ok.sum(1)
        deg[core] += ok[:, core].sum(0)
    return deg


def _cliques(x: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of unit vectors remain so that every two are similar: the least connected leaves first.

    One rule for any size: a row that leaves is compared with all, and no matrix of all pairs is held."""
    keep = np.ones(len(x), bool)
    deg = _degrees(x, cosine)
    left = len(x)
    while left:
        worst = int(deg.argmin())
        if deg[worst] >= left:
            break
        keep[worst] = False
        left -= 1
        deg -= x @ x[worst] >= cosine - 1e-6
        deg[worst] = 1 << 40
    return keep


def _split(x: np.ndarray, cosine: float, least: int, weight: np.ndarray | None = None, block: int = 1024) -> np.ndarray:
    """The number of its clique for each row of unit vectors, -1 for rows of none with ``least`` rows (each counts ``weight``).

    The row similar to most of the rest is taken with all rows similar to it, the least connected of which leave; those that
    are similar to all that stay come back. The rest is treated the same way. Rows with too few similar ones left are passed over."""
    weight = np.ones(len(x), np.int64) if weight is None else weight
    out = np.full(len(x), -1)
    if weight.sum() < least:
        return out
    if len(x) <= block and (x @ x.T >= cosine - 1e-6).all():  # as the steps below would find
        return np.zeros(len(x), np.int64)
    rest = np.arange(len(x))
    deg = _degrees(x, cosine)
    for number in range(len(x)):
        while True:  # a row of a clique is similar to at least as many rows as the clique has
            some = deg * weight.max(initial=1) >= least
            if some.all():
                break
            gone = rest[~some]
            rest, deg = rest[some], deg[some]
            deg = deg - _similar(x, rest, gone, cosine, block)
        if weight[rest].sum() < least:
            break
        near = rest[x[rest] @ x[rest[deg.argmax()]] >= cosine - 1e-6]
        keep = _cliques(x[near], cosine)
        clique, others = near[keep], near[~keep]
        back = others[_similar(x, others, clique, cosine, block) == len(clique)]
        if len(back):
            clique = np.concatenate([clique, back[_cliques(x[back], cosine)]])
        if weight[clique].sum() >= least:
            out[clique] = number
        else:  # its other rows may still belong to a larger one
            clique = rest[[deg.argmax()]]
        stay = ~np.isin(rest, clique)
        rest, deg = rest[stay], deg[stay]
        deg = deg - _similar(x, rest, clique, cosine, block)
    return out


def _similar(x: np.ndarray, rows: np.ndarray, among: np.ndarray, cosine: float, block: int) -> np.ndarray:
    """How many of the rows ``among`` each of ``rows`` is similar to."""
    n = np.zeros(len(rows), np.int64)
    for a in range(0, len(among), block):
        n += (x[rows] @ x[among[a : a + block]].T >= cosine - 1e-6).sum(1)
    return n


def _name(node: np.ndarray, flow: np.ndarray) -> int:
    """The node of the strongest flow names a set of nodes; ties go to the smaller."""
    return int(node[flow == flow.max()].min())


def checked_groups(rows: DataFrame, group: str, cosine: float, least: int) -> DataFrame:
    """(node, flow, copies, within, part, whole, head, mean): the nodes of every ``group`` (``within``) divided by ``_split``.

    ``part`` is a set of similar nodes (``whole``) or what is left of the group. ``head`` is the node that stands for a whole
    part, and a left node itself; at a head stands the mean of the vectors it stands for."""

    names = ["node", "flow", "copies", "within", "part", "whole", "head", "mean"]

    def check(batches):
        held, size = [], 0
        for pdf in iter_groups(batches, group):
            node, flow, copies, within = (pdf[c].to_numpy() for c in ("node", "flow", "copies", group))
            x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            number = _split(x, cosine, least, copies)
            for n in np.unique(number):
                own = np.flatnonzero(number == n)
                name = _name(node[own], flow[own])
                if n >= 0:
                    mean = [None] * len(own)
                    mean[int(np.flatnonzero(node[own] == name)[0])] = x[own].mean(0)
                else:
                    mean = list(x[own])
                one = np.full(len(own), name)
                held.append((node[own], flow[own], copies[own], within[own], one, np.full(len(own), n >= 0), one if n >= 0 else node[own], mean))
            size += len(pdf)
            if size > 20_000:
                yield pd.DataFrame({c: list(chain.from_iterable(h[i] for h in held)) if c == "mean" else np.concatenate([h[i] for h in held]) for i, c in enumerate(names)})
                held, size = [], 0
        if held:
            yield pd.DataFrame({c: list(chain.from_iterable(h[i] for h in held)) if c == "mean" else np.concatenate([h[i] for h in held]) for i, c in enumerate(names)})

    rows = rows.select(group, "node", "flow", "copies", "v").repartition(parallelism(rows.sparkSession), group).sortWithinPartitions(group, "node")
    return materialise(rows.mapInPandas(check, "node long, flow double, copies long, within long, part long, whole boolean, head long, mean array<float>"))


def rejoined(parts: DataFrame, edges: DataFrame, nodes: DataFrame, cosine: float, least: int) -> DataFrame:
    """``parts`` after a common check of those that Markov clustering put apart although they may belong together.

    Those are the parts with a link between them whose means have a product of ``cosine`` or more: the product is the mean of all
    cosines between the two, so no parts that are wholly similar are passed over."""
    side = parts.select("node", "within", "part", "head")
    a, b = (side.select(*[F.col(c).alias(c + s) for c in side.columns]) for s in "ab")
    across = edges.select(F.col("src").alias("nodea"), F.col("dst").alias("nodeb")).join(a, "nodea").join(b, "nodeb").where("withina <> withinb")
    across = materialise(across.select("parta", "heada", "partb", "headb").distinct())
    if across.isEmpty():
        return parts
    means = parts.where(F.col("mean").isNotNull())
    a, b = (means.select(F.col("head").alias("head" + s), F.col("mean").alias("mean" + s)) for s in "ab")
    dot = F.aggregate(F.zip_with("meana", "meanb", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    near = materialise(across.join(a, "heada").join(b, "headb").where(dot >= cosine - 1e-5).select(F.col("parta").alias("src"), F.col("partb").alias("dst")).distinct())
    if near.isEmpty():
        return parts
    groups = materialise(components(near).withColumnRenamed("node", "part"))
    again = parts.join(groups, "part").select("component", "node", "flow", "copies").join(nodes.select("node", "v"), "node")
    return parts.join(groups, "part", "left_anti").select(parts.columns).unionByName(checked_groups(again, "component", cosine, least))


class VectorClusters:
    """Clusters of the keys of a vector table; ``least`` different keys at least, every two of them at ``cosine`` or more."""

    def __init__(self, vectors: DataFrame, key: str = "chunk_id", vector: str = "vector", cosine: float = 0.85, least: int = 10) -> None:
        self.key, self.cosine, self.least = key, cosine, least
        rows = unit_vectors(vectors, key, vector)
        # a vector moves once, to meet its equals; keys and nodes go without it
        nodes = materialise(rows.groupBy("node").agg(F.first("v").alias("v")))
        self.units = materialise(rows.select(key, "node").dropDuplicates([key]))
        free_shuffles(vectors.sparkSession)
        edges = similar_pairs(nodes, cosine)
        copies = self.units.groupBy("node").agg(F.count("*").alias("copies"))
        # a set of equal vectors is a cluster of its own if it has no other links
        ends = F.explode(F.array("src", "dst")).alias("node")
        linked, weak = edges.where("strong").select(ends), edges.where("not strong").select(ends)
        alone = copies.where(F.col("copies") >= least).select("node").unionByName(weak).distinct().join(linked, "node", "left_anti")
        found = markov_clusters(edges.where("strong").drop("strong")).unionByName(alone.select("node", F.col("node").alias("cluster"), F.lit(1.0).alias("flow")))
        found = materialise(found.join(copies, "node"))
        free_shuffles(vectors.sparkSession)
        parts = checked_groups(nodes.join(small(found), "node"), "cluster", cosine, least)
        parts = rejoined(parts, edges, nodes, cosine, least).where("whole").select("node", "flow", "copies", F.col("part").alias("cluster"))
        sizes = parts.groupBy("cluster").agg(F.sum("copies").cast("int").alias("size"))
        self.members = self.units.select(key, "node").join(parts.select("node", "cluster", "flow"), "node").join(sizes, "cluster")

    def checked(self) -> DataFrame:
        """(key, cluster, size, flow) of the clusters, which are checked on the vectors; the others are noise."""
        return self.members.select(self.key, "cluster", "flow", "size")

    def pairs(self) -> DataFrame:
        """(key_a, key_b): every two keys of one cluster, key_a < key_b."""
        k = self.key
        c = materialise(self.checked().select(k, "cluster"))
        a, b = c.select(F.col(k).alias(f"{k}_a"), "cluster"), c.select(F.col(k).alias(f"{k}_b"), "cluster")
        return a.join(b, "cluster").where(F.col(f"{k}_a") < F.col(f"{k}_b")).select(f"{k}_a", f"{k}_b")

    def described(self, typical: int = 3) -> DataFrame:
        """(cluster, size, typical): the members of strongest flow represent a cluster; the size is that of all of it."""
        c = self.checked()
        w = Window.partitionBy("cluster").orderBy(F.desc("flow"), self.key)
        return c.withColumn("r", F.row_number().over(w)).where(F.col("r") <= typical).groupBy("cluster").agg(F.max("size").alias("size"), F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("r", self.key))), lambda x: x[self.key])).alias("typical"))
