"""Problem 9: passages of held-out test items inside training documents.

Winnowing: of the hashes of all runs of ``gram`` words the least of every ``window`` neighbours is kept, which guarantees that
two texts with ``gram + window - 1`` consecutive words in common share a kept hash. Fingerprints of documents and items are
joined; every hit is extended on the texts: the longest common run of words at the pair must reach ``least`` words.

Defined cases: null and blank texts have no fingerprint; items with fewer than ``least`` words can't leak; repeated rows count
once; hash ties inside a window keep the last, so equal passages keep equal places; an empty table gives an empty result;
extra columns are ignored; texts of any length are read whole. The item side is broadcast only if its fingerprints are few
(counted first), else both sides are shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import balanced, materialise, not_blank, parallelism, words
from corpusloom.llm.neardup import Hasher, _mix

#: Up to so many rows a side of a join is sent to all executors (24 bytes a row).
BROADCAST_ROWS = 500_000


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    if len(x) < gram:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(x) - gram + 1, np.uint64)
    for k in range(gram):
        h = _mix(h + x[k : len(x) - gram + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return h


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the last least hash of every window (of the whole, if it is shorter)."""
    if not len(h):
        return np.zeros(0, np.int64)
    if len(h) <= window:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))])
    least, at = h[: len(h) - window + 1].copy(), np.arange(len(h) - window + 1)
    for k in range(1, window):
        other = h[k : len(h) - window + 1 + k]
        lower = other <= least
        least[lower] = other[lower]
        at[lower] = np.flatnonzero(lower) + k
    return np.unique(at)


def fingerprints(df: DataFrame, key: str, gram: int, window: int) -> DataFrame:
    """(key, h): the distinct kept hashes of each text."""

    def prints(batches):
        hasher = Hasher()
        for pdf in batches:
            ids, hs = [], []
            for ident, text in zip(pdf[key], pdf["text"]):
                h = gram_hashes(hasher.ids(words(text)), gram)
                kept = np.unique(h[winnow(h, window)])
                ids.append(np.full(len(kept), ident))
                hs.append(kept)
            if ids and sum(map(len, ids)):
                yield pd.DataFrame({key: np.concatenate(ids), "h": np.concatenate(hs).view(np.int64)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "text").where(F.col(key).isNotNull() & not_blank(F.col("text"))).mapInPandas(prints, f"`{key}` {kind}, h long")


def longest_common_run(a: list[str], b: list[str], gram: int) -> int:
    """Length of the longest run of words in both, 0 if it is shorter than ``gram``: hits on runs of ``gram`` words, extended."""
    at: dict[tuple, list[int]] = {}
    for j in range(len(b) - gram + 1):
        at.setdefault(tuple(b[j : j + gram]), []).append(j)
    best, reach = 0, {}
    for i in range(len(a) - gram + 1):
        for j in at.get(tuple(a[i : i + gram]), ()):
            if reach.get(i - j, -1) > i:  # inside a run already measured
                continue
            n = gram
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            reach[i - j] = i + n
            best = max(best, n)
    return best


def _small(df: DataFrame, what: DataFrame) -> DataFrame:
    return F.broadcast(what) if what.count() <= BROADCAST_ROWS else what


def leaked_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", least: int = 12, gram: int = 6) -> DataFrame:
    """(key, item, words): documents with at least ``least`` consecutive words of an item, and the longest such run."""
    if not 0 < gram <= least:
        raise ValueError("gram must lie between 1 and least")
    window = least - gram + 1
    of_items = materialise(fingerprints(items.dropDuplicates([item]).repartition(parallelism(docs.sparkSession), item), item, gram, window).distinct())
    wide = balanced(docs.select(key, "text"), key)
    of_docs = fingerprints(wide, key, gram, window)
    # beyond the broadcast, a fingerprint that very many documents hold is a skewed partition of a plain join, which is split at run time
    hits = materialise(of_docs.join(_small(of_docs, of_items), "h").select(key, item).distinct())
    probe = _small(docs, hits)
    tests = items.dropDuplicates([item]).select(item, F.col("text").alias("item_text"))
    pairs = docs.select(key, "text").where(F.col("text").isNotNull()).join(probe, key).join(tests, item)

    def extend(batches):
        for pdf in batches:
            known: dict = {}
            n = []
            for t, it, raw in zip(pdf["text"], pdf[item], pdf["item_text"]):
                if it not in known:
                    known[it] = words(raw)
                n.append(longest_common_run(words(t), known[it], gram))
            out = pdf[[key, item]].assign(words=np.array(n, np.int32))
            yield out[out["words"] >= least]

    kinds = f"`{key}` {docs.schema[key].dataType.simpleString()}, `{item}` {items.schema[item].dataType.simpleString()}, words int"
    return pairs.mapInPandas(extend, kinds).groupBy(key, item).agg(F.max("words").alias("words"))
