"""Problem 8: lay documents into containers of a fixed number of tokens by lexical retrieval.

Items (documents, or pieces of those larger than a container, cut at word ends) go to shards of about ``shard_rows`` like ones: a
spherical k-means, fitted to the word vectors of all items with the word counts of all items, assigns every item to
a cell; inside a cell items follow one another by their telling word (a MinHash weighted by rarity), and the row of all cells is cut
into shards of equal size, through a large group of one word as well, so that no shard grows with the data. Each shard builds an
inverted BM25 index of its items; the largest unused item seeds a container, and the index returns the unused items most like it,
which fill the container greedily: the choice weighs the score against the room it fills. What is left over of the containers of a
shard is joined best fit first, and containers with room left are laid anew with those of the next shards. Texts never move: cells, sizes and term numbers do.

Defined cases: null and blank texts have no tokens and get no container; keys are unique, repeated rows count once; ties go to
the smaller key; an empty table gives an empty result; a text of any length is read whole; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.base import balanced, free_shuffles, iter_groups, materialise, not_blank, parallelism
from corpusloom.llm.tokens import PieceCounter, counter_of

#: A word, or any other non-blank character.
_UNIT = re.compile(r"[^\W_]+|[^\w\s]|_")


def cut_sizes(text: str, counter: PieceCounter, capacity: int) -> tuple[int, list[tuple[int, int, int]]]:
    """(tokens, [(start, end, tokens) of the pieces in code points of the lower-cased text]); one piece if it fits."""
    low = text.lower()
    total = counter.count(text)
    if total <= capacity:
        return total, [(0, len(low), total)]
    out, a, n, end = [], 0, 0, 0
    for m in _UNIT.finditer(low):
        w = m.group()
        t = counter[w] if w[0].isalnum() else 1
        while t > capacity:  # a single word beyond the capacity is cut between its pieces
            if n:
                out.append((a, m.start(), n))
            out.append((m.start(), m.end(), capacity))
            a, n, t = m.end(), 0, t - capacity
        if n + t > capacity:
            out.append((a, m.start(), n))
            a, n = m.start(), 0
        n, end = n + t, m.end()
    if n:
        out.append((a, end, n))
    return total, out


class BM25Index:
    """Postings of the terms that at least two items and at most half of them hold."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], k1: float = 1.2, b: float = 0.75) -> None:
        n = self.n = len(terms)
        t = np.concatenate([*terms, np.zeros(0, np.int32)])
        item = np.repeat(np.arange(n), [len(x) for x in terms])
        tf = np.concatenate([*counts, np.zeros(0, np.int32)]).astype(np.float64)
        order = np.argsort(t, kind="stable")
        every, first, df = np.unique(t[order], return_index=True, return_counts=True)
        size = np.array([x.sum() for x in counts], np.float64)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5)) * ((df >= 2) & (df <= max(2, n // 2)))
        self.every, self.first, self.last = every, first, first + df
        self.item = item[order]
        norm = k1 * (1 - b + b * size / max(1.0, size.mean() if n else 1.0))
        self.weight = (np.repeat(idf, df) * tf[order] * (k1 + 1) / (tf[order] + norm[self.item])) if len(t) else tf
        self.used = idf > 0

    def scores(self, terms: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.every, terms)
        at = at[self.used[at]]
        if not len(at):
            return np.zeros(self.n)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(self.first[at].tolist(), self.last[at].tolist())])
        return np.bincount(self.item[rows], weights=self.weight[rows], minlength=self.n)


def pack_items(sizes: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray], capacity: int) -> np.ndarray:
    """Container number of each item, of its term numbers (sorted) and their counts; every container's sizes sum to at most ``capacity``."""
    n = len(sizes)
    box = np.full(n, -1, np.int64)
    index = BM25Index(terms, counts)
    order = np.argsort(-sizes, kind="stable")
    free = np.ones(n, bool)
    smallest_first = np.sort(sizes)
    c = 0
    for seed in order.tolist():
        if not free[seed]:
            continue
        free[seed] = False
        box[seed] = c
        room = capacity - int(sizes[seed])
        if room >= smallest_first[0] and free.any():
            score = index.scores(terms[seed])
            top = float(score[free].max()) or 1.0
            cand = np.flatnonzero(free & (sizes <= room))
            s = score[cand] / top
            z = sizes[cand]
            while len(cand):
                pick = int(np.argmax(s + z / room))
                box[cand[pick]] = c
                free[cand[pick]] = False
                room -= int(z[pick])
                keep = z <= room
                keep[pick] = False
                cand, s, z = cand[keep], s[keep], z[keep]
        c += 1
    # join what is left over: best fit in order of size
    load = np.bincount(box, weights=sizes, minlength=c).astype(np.int64) if n else np.zeros(0, np.int64)
    target = np.arange(c)
    opened: list[int] = []
    for x in np.argsort(-load, kind="stable").tolist():
        fits = [y for y in opened if load[y] + load[x] <= capacity]
        if fits:
            y = max(fits, key=lambda v: load[v])
            load[y] += load[x]
            target[x] = y
            if load[y] > capacity - smallest_first[0]:
                opened.remove(y)
        elif load[x] <= capacity - smallest_first[0]:
            opened.append(x)
    return refilled(sizes, target[box], capacity) if n else box


def refilled(sizes: np.ndarray, box: np.ndarray, capacity: int, full: float = 0.97) -> np.ndarray:
    """The items of the containers that are not ``full`` laid anew, the largest first, each where it fits best; kept if that needs fewer."""
    _, box = np.unique(box, return_inverse=True)
    load = np.bincount(box, weights=sizes).astype(np.int64)
    loose = load < full * capacity
    out, room = box.copy(), np.where(loose, -1, capacity - load)
    fresh = np.flatnonzero(loose).tolist()[::-1]  # numbers that may be opened again
    opened = 0
    moved = np.flatnonzero(loose[box])
    for i in moved[np.argsort(-sizes[moved], kind="stable")].tolist():
        fits = np.where(room >= sizes[i], room, capacity + 1)
        k = int(fits.argmin())
        if fits[k] > capacity:
            if not fresh:
                return box
            k, opened = fresh.pop(), opened + 1
            room[k] = capacity
        room[k] -= sizes[i]
        out[i] = k
    return out if opened < loose.sum() else box


_LETTERS = re.compile(r"[^\W\d_]{3,}")


class _Numbers(dict):
    """word -> its number; fills itself on demand."""

    def __missing__(self, w: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[w] = n = int(np.array(xxhash.xxh32_intdigest(w), np.uint32).astype(np.int32))
        return n


_NUMBERS = _Numbers()


def bag(low: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(sorted term numbers, their counts, the distinct words) of a lower-cased text."""
    n = Counter(_LETTERS.findall(low))
    t = np.fromiter(map(_NUMBERS.__getitem__, n), np.int32, len(n))
    order = np.argsort(t)
    return t[order], np.fromiter(n.values(), np.int32, len(n))[order], list(n)


class Places:
    """Cells of like items: ``terms`` are the numbers of the words that count (sorted), ``rarity`` their weights, ``centres`` those of the cells."""

    dims = 256

    def __init__(self, terms: np.ndarray, rarity: np.ndarray) -> None:
        self.terms, self.rarity, self.centres = terms, rarity, np.zeros((1, self.dims), np.float32)
        self.dim = terms.astype(np.int64) % self.dims
        self.value = np.where((terms >> 16) & 1, rarity, -rarity)
        lot = np.array([-math.log((xxhash.xxh64_intdigest(t.tobytes(), seed=1) + 1) / 2**64) for t in terms]) / np.maximum(rarity, 1e-9)
        self.by_lot = np.argsort(lot, kind="stable")
        self.rank = np.argsort(self.by_lot)

    def _words(self, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(item, place in ``terms``) of each word that counts, of the term numbers of many items."""
        t = np.frombuffer(b"".join(held), np.int32)
        item = np.repeat(np.arange(len(held)), [len(x) // 4 for x in held])
        if not len(self.terms):
            return item[:0], item[:0]
        i = np.minimum(np.searchsorted(self.terms, t), len(self.terms) - 1)
        known = self.terms[i] == t
        return item[known], i[known]

    def vectors(self, held: list[bytes]) -> np.ndarray:
        """Unit vectors in the hashed word space in bytes of each one's own scale, zeros for items without words that count."""
        item, i = self._words(held)
        x = np.bincount(item * self.dims + self.dim[i], weights=self.value[i], minlength=len(held) * self.dims).reshape(-1, self.dims)
        return np.rint(x * (127 / np.maximum(np.abs(x).max(1, keepdims=True), 1e-9))).astype(np.int8)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit vectors, cells) of vectors in bytes."""
        x = x.astype(np.float32)
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1)
        return x, (x @ self.centres.T).argmax(1)

    def __call__(self, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(cells, numbers of the telling words) of many items; 0 for items without words that count."""
        item, i = self._words(held)
        first = np.full(len(held), len(self.terms), np.int64)
        np.minimum.at(first, item, self.rank[i])
        telling = np.append(self.terms[self.by_lot], np.int32(0))[first]
        return self.cells(self.vectors(held))[1].astype(np.int32), telling


def fit_places(items: DataFrame, key: str, cells: int, rate: float = 3 / 5000, rounds: int = 12) -> Places:
    """Places fitted to all items, given their ``terms``: words of at least three items and of ``rate`` of them, at most of half of them, count.

    Spherical k-means: every round goes over all items and adds up whole numbers, so that the partitions don't matter. Cells are numbered
    along the direction in which their centres differ most."""
    spark = items.sparkSession
    n = items.count()

    def count(batches):
        for pdf in batches:
            t, k = np.unique(np.frombuffer(b"".join(pdf["terms"]), np.int32), return_counts=True)
            yield pd.DataFrame({"t": t, "n": k})

    held = items.select("terms").mapInPandas(count, "t int, n long").groupBy("t").agg(F.sum("n").alias("n"))
    held = held.where(F.col("n").between(max(min(3, n), rate * n), max(3, n // 2))).orderBy("t").toPandas()
    df = held["n"].to_numpy(np.float64)
    places = Places(held["t"].to_numpy(np.int32), np.log(1 + (n - df + 0.5) / (df + 0.5)))
    shared = spark.sparkContext.broadcast(places)

    def vectors(batches):
        for pdf in batches:
            x = shared.value.vectors(list(pdf["terms"]))
            some = x.any(1)
            yield pd.DataFrame({"h": pdf["h"][some], "x": [v.tobytes() for v in x[some]]})

    x = materialise(items.select(F.xxhash64(key, "piece_no").alias("h"), "terms").mapInPandas(vectors, "h long, x binary"))
    read = lambda rows: np.frombuffer(b"".join(rows), np.int8).reshape(-1, Places.dims)
    seeds = read(list(dict.fromkeys(bytes(r["x"]) for r in x.orderBy("h", "x").limit(4 * cells).collect()))[:cells])
    if len(seeds):
        places.centres = places.cells(seeds)[0]

    for _ in range(rounds if len(seeds) else 0):
        now = Places(places.terms[:0], places.rarity[:0])
        now.centres = places.centres

        def add(batches, now=now):
            total = np.zeros((len(now.centres), now.dims), np.int64)
            for pdf in batches:
                unit, own = now.cells(read(pdf["x"]))
                order = np.argsort(own, kind="stable")
                cell, first = np.unique(own[order], return_index=True)
                total[cell] += np.add.reduceat(np.rint(unit[order] * 65536).astype(np.int32), first, axis=0, dtype=np.int64)
            some = np.flatnonzero(total.any(1))
            yield pd.DataFrame({"cell": some.astype(np.int32), "total": [total[c].tobytes() for c in some]})

        def add_up(batches):
            total: dict[int, np.ndarray] = {}
            for pdf in batches:
                for c, t in zip(pdf["cell"], pdf["total"]):
                    total[c] = total.get(c, 0) + np.frombuffer(t, np.int64)
            yield pd.DataFrame({"cell": list(total), "total": [t.tobytes() for t in total.values()]})

        kind = "cell int, total binary"
        c = places.centres.copy()
        for r in x.mapInPandas(add, kind).repartition(min(8, cells), "cell").mapInPandas(add_up, kind).collect():
            t = np.frombuffer(r["total"], np.int64).astype(np.float64)
            c[r["cell"]] = t / np.linalg.norm(t)
        moved, places.centres = float(np.abs(c - places.centres).max()), c
        if moved < 1e-6:
            break
    if len(seeds):
        u = places.centres - places.centres.mean(0)
        places.centres = places.centres[np.argsort(u @ np.linalg.svd(u, full_matrices=False)[2][0], kind="stable")]
    del x
    free_shuffles(spark)
    return places


def pack_documents(docs: DataFrame, pieces: set[str], key: str = "doc_id", capacity: int = 1024, shard_rows: int = 1200, cells: int = 64) -> DataFrame:
    """(key, piece_no, n_pieces, start, end, tokens, container, shard): one row per document, or per piece of a larger one."""
    rows = docs.select(key, "text").where(F.col(key).isNotNull() & not_blank(F.col("text")))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pieces)
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches):
        counter = counter_of(shared)
        for pdf in batches:
            out = []
            for ident, text in zip(pdf[key], pdf["text"]):
                _, cuts = cut_sizes(text, counter, capacity)
                low = text.lower()
                for no, (a, b, t) in enumerate(cuts):
                    terms, n, _ = bag(low[a:b])
                    out.append((ident, no, len(cuts), a, b, t, terms.tobytes(), n.tobytes()))
            yield pd.DataFrame(out, columns=[key, "piece_no", "n_pieces", "start", "end", "tokens", "terms", "counts"])

    fields = f"`{key}` {kind}, piece_no int, n_pieces int, start int, end int, tokens int"
    cut_items = materialise(balanced(rows, key).mapInPandas(cut, fields + ", terms binary, counts binary"))
    places = spark.sparkContext.broadcast(fit_places(cut_items, key, cells))

    def place(batches):
        for pdf in batches:
            cell, telling = places.value(list(pdf["terms"]))
            yield pdf.assign(cell=cell, telling=telling)

    items = cut_items.mapInPandas(place, fields + ", terms binary, counts binary, cell int, telling int")
    held = cut_items.select("terms").mapInPandas(place, "terms binary, cell int, telling int")
    # where the group of a telling word begins in its cell; groups are at most cells x words that count
    groups = held.groupBy("cell", "telling").agg(F.count("*").alias("group_n"))
    groups = groups.withColumn("begin", F.sum("group_n").over(Window.partitionBy("cell").orderBy("telling")) - F.col("group_n"))
    sizes = groups.groupBy("cell").agg(F.sum("group_n").alias("cell_n"))
    before = sizes.select("cell", (F.sum("cell_n").over(Window.orderBy("cell")) - F.col("cell_n")).alias("before"))  # a row a cell
    groups = groups.join(F.broadcast(before), "cell").select("cell", "telling", "group_n", (F.col("before") + F.col("begin")).alias("begin"))
    at = F.col("begin") + F.pmod(F.xxhash64(key, "piece_no"), F.col("group_n"))
    placed = items.join(F.broadcast(groups), ["cell", "telling"]).withColumn("shard", F.floor(at / shard_rows).cast("int")).drop("cell", "telling")
    placed = placed.repartition(parallelism(spark), "shard").sortWithinPartitions("shard", key, "piece_no")

    def pack(batches):
        for pdf in iter_groups(batches, "shard"):
            pdf = pdf.drop_duplicates([key, "piece_no"])
            read = lambda c: [np.frombuffer(x, np.int32) for x in pdf[c]]  # noqa: B023, E731
            box = pack_items(pdf["tokens"].to_numpy(np.int64), read("terms"), read("counts"), capacity)
            name = int(pdf["shard"].iloc[0])
            load = np.bincount(box, weights=pdf["tokens"].to_numpy()).astype(np.int64)
            yield pdf[[key, "piece_no", "n_pieces", "start", "end", "tokens"]].assign(container=[f"{name}-{x}" for x in box], shard=name, filled=load[box])

    def repack(batches):
        for pdf in iter_groups(batches, "rest"):
            box = np.unique(pdf["container"].to_numpy(), return_inverse=True)[1]
            new = refilled(pdf["tokens"].to_numpy(np.int64), box, capacity, full=2.0)
            if new is not box:
                pdf = pdf.assign(container=[f"r{pdf['rest'].iloc[0]}-{x}" for x in new])
            yield pdf.drop(columns=["rest", "filled"])

    packed = materialise(placed.select(key, "piece_no", "n_pieces", "start", "end", "tokens", "shard", "terms", "counts").mapInPandas(pack, fields + ", container string, shard int, filled long"))
    # what lies in containers with room left is laid anew together with that of the shards beside it
    roomy = F.col("filled") < int(0.97 * capacity)
    rest = packed.where(roomy).withColumn("rest", F.floor(F.col("shard") / 8).cast("int")).repartition(parallelism(spark), "rest").sortWithinPartitions("rest", key, "piece_no")
    return packed.where(~roomy).drop("filled").unionByName(rest.mapInPandas(repack, fields + ", container string, shard int"))
