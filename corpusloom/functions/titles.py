"""Likeness of titles: twice the longest common subsequence over the summed lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from corpusloom.functions.text import normalize_title
from corpusloom.session import materialise, parallelism


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one integer."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 for two empty titles; null if either is null."""

    def one(x, y):
        if x is None or y is None:
            return None
        n = len(x) + len(y)
        return 1.0 if n == 0 else 2.0 * common_subsequence(x, y) / n

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def is_duplicate_title(a: Column, b: Column, threshold: float = 0.85) -> Column:
    return indel_ratio(normalize_title(a), normalize_title(b)) >= threshold


#: The bound before the exact comparison counts characters in so many lots, each in so many steps at most.
_LOTS, _STEPS = 64, 8
#: So many titles are compared with so many at once.
_TILE = 1024


class _Tile:
    """Titles as code points, with their sizes and their characters counted by lots."""

    def __init__(self, titles: list[str]) -> None:
        self.size = np.array([len(t) for t in titles], np.int64)
        self.points = np.frombuffer("".join(titles).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.row = np.repeat(np.arange(len(titles)), self.size)
        self.col = np.arange(len(self.points)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.lots = np.bincount(self.row * _LOTS + self.points % _LOTS, minlength=len(titles) * _LOTS).reshape(-1, _LOTS).astype(np.int32)

    def masks(self) -> tuple[np.ndarray, np.ndarray]:
        """(characters, word x character x title: the places at which the title holds it, as bits); the last character stands for all others."""
        every, code = np.unique(self.points, return_inverse=True)
        out = np.zeros((int(self.size.max() + 63) // 64, len(every) + 1, len(self.size)), np.uint64)
        np.bitwise_or.at(out, (self.col // 64, code, self.row), np.uint64(1) << (self.col % 64).astype(np.uint64))
        return every, out

    def codes(self, every: np.ndarray) -> np.ndarray:
        """place x title: number of the character among ``every``, their count where it is none of them."""
        at = np.minimum(np.searchsorted(every, self.points), len(every) - 1)
        out = np.full((int(self.size.max()), len(self.size)), len(every), np.int64)
        out[self.col, self.row] = np.where(every[at] == self.points, at, len(every))
        return out


def _candidates(x: _Tile, y: _Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose characters allow the threshold: a common subsequence is not longer than the sum of the lesser counts.

    Lots of several characters and counts in steps can only raise that bound; one product of matrices sums it, less what is needed."""
    most = np.minimum(x.lots.max(0), y.lots.max(0))
    step = -(-most // _STEPS)
    at = [(lot, k * step[lot]) for lot in np.flatnonzero(most).tolist() for k in range(-(-int(most[lot]) // int(step[lot])))]
    lot, over = np.array(at, np.int64).reshape(-1, 2).T
    one = lambda z: np.ones((len(z.size), 1))
    need = lambda z: z.size[:, None] * (-threshold / 2)
    a = np.hstack([(x.lots[:, lot] > over) * step[lot], need(x), one(x)]).astype(np.float32)
    b = np.hstack([y.lots[:, lot] > over, one(y), need(y)]).astype(np.float32)
    slack = 0.01 + 1e-5 * float(x.size.max() + y.size.max())  # of single precision
    i, j = np.divmod(np.flatnonzero((a @ b.T).ravel() >= -slack), len(y.size))
    fits = 2.0 * np.minimum(x.size[i], y.size[j]) >= threshold * (x.size[i] + y.size[j]) - slack
    return i[fits], j[fits]


def _subsequences(codes: np.ndarray, masks: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``common_subsequence`` of many pairs at once: titles i, given by ``codes``, with titles j, given by ``masks`` and ``size``."""
    words = len(masks)
    flat = masks.reshape(words, -1)
    rows = [np.full(len(i), 2**64 - 1, np.uint64) for _ in range(words)]
    for code in codes * len(size):
        at = code[i] + j
        carry = np.uint64(0)
        for w in range(words):
            hit = rows[w] & flat[w][at]
            total = rows[w] + hit
            if words > 1:  # what runs over goes on in the next word
                over = total < hit
                total += carry
                carry = (over | (total < carry)).astype(np.uint64)
            rows[w] = total | (rows[w] ^ hit)
    found = np.zeros(len(i), np.int64)
    for w in range(words):
        bits = np.clip(size[j] - 64 * w, 0, 64).astype(np.uint64)
        within = np.where(bits == 64, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(bits, np.uint64(63))) - np.uint64(1))
        found += np.bitwise_count(~rows[w] & within)
    return found


def like_titles(x: list[str], y: list[str] | None = None, threshold: float = 0.85, at_once: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs of like titles of ``x`` and ``y``, none of them empty; without ``y`` of the pairs i < j within ``x``."""
    own = [(a, _Tile(x[a : a + _TILE])) for a in range(0, len(x), _TILE)]
    others = own if y is None else [(b, _Tile(y[b : b + _TILE])) for b in range(0, len(y), _TILE)]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for b, q in others:
        held = None
        for a, p in own:
            long, short = max(p.size.min(), q.size.min()), min(p.size.max(), q.size.max())  # the nearest sizes, if the ranges do not meet
            if y is None and a > b or 2.0 * short < threshold * (short + long):
                continue
            i, j = _candidates(p, q, threshold)
            if y is None and a == b:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            held = held or q.masks()
            codes = p.codes(held[0])
            for k in range(0, len(i), at_once):
                m, n = i[k : k + at_once], j[k : k + at_once]
                like = 2.0 * _subsequences(codes, held[1], q.size, m, n) / (p.size[m] + q.size[n]) >= threshold
                found.append((m[like] + a, n[like] + b))
    return np.concatenate([m for m, _ in found]), np.concatenate([n for _, n in found])


def _runs(sizes: list[tuple[int, int]], rows: int) -> list[tuple[int, int, int, int]]:
    """(first size, last size, first block, blocks) of runs of sizes, from sorted (size, titles); a block has about ``rows`` titles, fewer of longer ones."""
    out: list[tuple[int, int, int, int]] = []
    weight, first, block = 0.0, None, 0
    for k, (size, n) in enumerate(sizes):
        weight, first = weight + n * max(1, size / 64), first or size
        if weight >= rows or k + 1 == len(sizes):
            parts = max(1, round(weight / rows))
            out.append((first, size, block, parts))
            weight, first, block = 0.0, None, block + parts
    return out


def fuzzy_title_links(records: DataFrame, key: str, title: str = "title", threshold: float = 0.85, most: int = 8000) -> DataFrame:
    """(key, title, links): how many other titles are like each one; complete.

    Equal titles are one class. Classes lie in blocks of neighbouring sizes, of about ``most`` at most; each two blocks whose sizes allow the
    threshold meet in one task, which compares what a bound by counts of characters leaves. Pairs of titles are never moved, only their number."""
    spark = records.sparkSession
    titles = records.select(key, normalize_title(F.col(title)).alias("t"))
    classes = materialise(titles.where("t is not null and t <> ''").groupBy("t").agg(F.count("*").alias("copies")))
    sizes = sorted((r["n"], r["titles"]) for r in classes.groupBy(F.length("t").alias("n")).agg(F.count("*").alias("titles")).collect())
    runs = _runs(sizes, max(250, min(most, sum(n for _, n in sizes) // 16)))
    # sizes grow with the blocks: a block meets those from itself to the last one whose least size is not too far from its own largest
    until = [max(b + n for f, _, b, n in runs if 2.0 * last >= threshold * (last + f) or f <= last) - 1 for _, last, _, parts in runs for _ in range(parts)]
    since = [next(i for i, u in enumerate(until) if u >= j) for j in range(len(until))]
    meets = spark.createDataFrame(list(zip(range(len(until)), since, until)), "block int, since int, until int")
    run = spark.createDataFrame(runs, "first int, last int, begin int, parts int")
    placed = classes.join(F.broadcast(run), F.length("t").between(F.col("first"), F.col("last")))
    placed = placed.select((F.col("begin") + F.pmod(F.xxhash64("t"), F.col("parts"))).cast("int").alias("block"), F.struct(F.length("t"), "t", "copies").alias("x"))
    blocks = placed.groupBy("block").agg(F.array_sort(F.collect_list("x")).alias("x")).join(F.broadcast(meets), "block")
    tasks = max(4 * parallelism(spark), sum(u - i + 1 for i, u in enumerate(until)) // 8)
    x = blocks.select(F.col("block").alias("i"), F.explode(F.sequence("block", "until")).alias("j"), F.col("x.t").alias("a"), F.col("x.copies").alias("na"))
    y = blocks.select(F.explode(F.sequence("since", "block")).alias("i"), F.col("block").alias("j"), F.col("x.t").alias("b"), F.col("x.copies").alias("nb")).where("i < j")
    met = x.repartition(tasks, "i", "j").join(y.repartition(tasks, "i", "j"), ["i", "j"], "left").select("a", "na", "b", "nb")

    def compare(batches):
        for pdf in batches:
            for a, na, b, nb in pdf.itertuples(index=False):
                i, j = like_titles(list(a), None if b is None else list(b), threshold)
                b, nb = (a, na) if b is None else (b, nb)
                of_a, of_b = np.bincount(i, weights=nb[j], minlength=len(a)), np.bincount(j, weights=na[i], minlength=len(b))
                for t, n in ((a, of_a), (b, of_b)):
                    yield pd.DataFrame({"t": t[n > 0], "links": n[n > 0].astype(np.int64)})

    linked = met.mapInPandas(compare, "t string, links long").groupBy("t").agg(F.sum("links").alias("l"))
    per = classes.join(linked, "t", "left").select("t", (F.col("copies") - 1 + F.coalesce("l", F.lit(0))).alias("links"))
    return titles.join(per, "t", "left").select(key, F.col("t").alias("title"), F.coalesce("links", F.lit(0)).alias("links"))
