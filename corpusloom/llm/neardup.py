"""Problem 4: groups of records that are versions of each other.

A text's shingles (runs of ``shingle`` words) are hashed; texts with the same shingle set form one class and are handled as
one. MinHash values in bands give candidate pairs; an odd sketch (the parity of the MinHash samples folded into a bitmap)
of each candidate estimates the similarity from the population count of the XOR, inside the JVM; what lies within four standard
deviations of the threshold or above is checked exactly on the shingle hashes. Nothing is collected; the number of bands follows from the threshold alone.

Defined cases: null and blank texts give no row; ids count once; texts with fewer words than a shingle have no shingles: they
match only texts of the very same words if ``short`` is set, and nothing otherwise; exact copies are one class, expanded only
where pairs are asked for; an empty table gives an empty result; ties and repeated rows do not matter, as pairs are sets; extra
columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import distinct_texts, materialise, parallelism, spread, words

#: Length of a sketch in bits, and the least number of MinHash samples folded into it: more than the bands need, so that it is precise.
BITS, SAMPLES = 2048, 384
#: Classes of a bucket that one task compares with each other; larger buckets are divided into blocks of about so many.
BLOCK = 256
#: Up to so many class hashes (8 bytes each) are sent to all executors.
BROADCAST_ROWS = 1_000_000


def banding(threshold: float, miss: float = 2e-4) -> tuple[int, int]:
    """(rows, bands): a pair at the threshold shares no band with a probability of at most ``miss``."""
    rows = max(2, round(3 + 4 * (threshold - 0.5) / 0.3))
    return rows, math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def most_differing(threshold: float, k: int, deviations: float = 4.0) -> float:
    """Differing bits of two odd sketches of ``k`` samples that a pair at the threshold exceeds only beyond so many standard deviations.

    d = 2 k (1 - J) samples differ on average; a share p = (1 - exp(-2 d / BITS)) / 2 of the bits then does. The deviation holds that of
    the samples (binomial) and that of the bits."""
    keep = math.exp(-4 * k * (1 - threshold) / BITS)
    p = (1 - keep) / 2
    return BITS * p + deviations * math.sqrt(4 * keep * keep * k * threshold * (1 - threshold) + BITS * p * (1 - p))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Word hashes, kept per worker; equal on all machines."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def ids(self, ws: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 2_000_000:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        except KeyError:
            import xxhash

            for w in set(ws).difference(known):
                known[w] = xxhash.xxh64_intdigest(w)
            return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))

    def shingles(self, ws: list[str], size: int) -> np.ndarray:
        """Sorted distinct hashes of the runs of ``size`` words."""
        if len(ws) < size:
            return np.zeros(0, np.uint64)
        x = self.ids(ws)
        h = np.zeros(len(x) - size + 1, np.uint64)
        for k in range(size):
            h = _mix(h + x[k : len(x) - size + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
        return np.unique(h)


    def sequence(self, ws: list[str]) -> int:
        """A hash of the words in their order, for texts without a shingle."""
        h = np.array([len(ws) ^ 0x5851F42D4C957F2D], np.uint64)
        with np.errstate(over="ignore"):
            for x in self.ids(ws):
                h = _mix(h * np.uint64(31) + x)
        return int(h.astype(np.int64)[0])


def signatures(texts: DataFrame, key: str, shingle: int, rows: int, bands: int, short: bool = False) -> DataFrame:
    """(key, class_hash, n, shingles, bands, sketch) of every text with at least one shingle; with ``short`` of the others too,
    which have no arrays and share a class if their words are the same (the whole text stands for a word where there is none).

    A class that a task has met before comes without its arrays, so copies are combined before any shuffle."""
    k = max(rows * bands, SAMPLES)
    rng = np.random.default_rng(20240229)
    a = (rng.integers(1, 2**32, k, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    b = rng.integers(0, 2**32, k, dtype=np.uint64).astype(np.uint32)

    def sign(batches):
        hasher, met = Hasher(), set()
        seat = _mix(np.arange(k, dtype=np.uint64) + np.uint64(1))
        for pdf in batches:
            out = []
            for ident, text in zip(pdf[key], pdf["text"]):
                ws = words(text)
                s = hasher.shingles(ws, shingle)
                if not len(s):
                    if short:
                        out.append((ident, hasher.sequence(ws or [text.strip()]), 0, None, None, None))
                    continue
                with np.errstate(over="ignore"):
                    whole = int(_mix(np.add.reduce(_mix(s), dtype=np.uint64) + np.uint64(len(s))).astype(np.int64))
                if whole in met:
                    out.append((ident, whole, len(s), None, None, None))
                    continue
                if len(met) < 2_000_000:
                    met.add(whole)
                x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
                mins = np.full(k, 0xFFFFFFFF, np.uint32)
                for at in range(0, len(x), 4096):  # long texts in steps of bounded memory
                    np.minimum(mins, (x[at : at + 4096, None] * a + b).min(0), out=mins)
                with np.errstate(over="ignore"):
                    band = np.zeros(bands, np.uint64)
                    m = mins[: rows * bands].reshape(bands, rows).astype(np.uint64)
                    for r in range(rows):
                        band = _mix(band * np.uint64(31) + m[:, r] + np.uint64(7))
                    bit = _mix(mins.astype(np.uint64) + seat) % np.uint64(BITS)
                parity = np.bincount(bit.astype(np.int64), minlength=BITS) & 1
                sketch = np.packbits(parity.astype(np.uint8)).view(np.int64)
                out.append((ident, whole, len(s), s.view(np.int64), band.view(np.int64), sketch))
            yield pd.DataFrame(out, columns=[key, "class_hash", "n", "shingles", "bands", "sketch"])

    kind = texts.schema[key].dataType.simpleString()
    return spread(texts.select(key, "text"), key).mapInPandas(sign, f"`{key}` {kind}, class_hash long, n int, shingles array<long>, bands array<long>, sketch array<long>")


def candidate_pairs(classes: DataFrame) -> DataFrame:
    """(class_a, class_b) of different classes that share a band; class_a < class_b.

    A bucket of n classes is divided into B = ceil(n / BLOCK) blocks and its pairs into B x B cells, each of them joined by itself, so
    that no task meets a whole hot bucket and no pair is lost: a pair meets in the one cell of its two blocks."""
    parts = parallelism(classes.sparkSession)
    slots = classes.select("class_hash", F.posexplode("bands").alias("band", "h")).select(F.xxhash64("band", "h").alias("bucket"), "class_hash")
    # partitioned by bucket once: the distinct rows, the sizes and their join keep that partitioning
    slots = slots.repartition(parts, "bucket").distinct()
    sizes = slots.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    placed = slots.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("class_hash"), F.col("blocks")).cast("int"))
    placed = materialise(placed.select("bucket", "class_hash", "blocks", "own"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    x = placed.select("bucket", F.col("own").alias("i"), every.alias("j"), F.col("class_hash").alias("class_a"))
    y = placed.select("bucket", every.alias("i"), F.col("own").alias("j"), F.col("class_hash").alias("class_b"))
    return x.join(y, ["bucket", "i", "j"]).where("class_a < class_b").select("class_a", "class_b").distinct()


def similar_classes(classes: DataFrame, threshold: float, k: int) -> DataFrame:
    """(class_a, class_b, similarity) of all pairs of different classes that reach the threshold; class_a < class_b."""
    pairs = materialise(candidate_pairs(classes))
    side = lambda df, s, *cols: df.select(F.col("class_hash").alias(f"class_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in cols])
    # first the sketches of all candidates, then the shingles of those that pass
    light = classes.select("class_hash", "n", "sketch").dropDuplicates(["class_hash"])
    told = pairs.join(side(light, "a", "n", "sketch"), "class_a").join(side(light, "b", "n", "sketch"), "class_b")
    differ = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    least = F.least("n_a", "n_b") / F.greatest("n_a", "n_b")
    likely = materialise(told.where((differ <= most_differing(threshold, k)) & (least >= threshold)).select("class_a", "class_b"))
    ends = likely.select(F.col("class_a").alias("class_hash")).unionByName(likely.select(F.col("class_b").alias("class_hash"))).distinct()
    few = F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends
    heavy = classes.select("class_hash", "shingles").join(few, "class_hash", "left_semi").dropDuplicates(["class_hash"])
    both = likely.join(side(heavy, "a", "shingles"), "class_a").join(side(heavy, "b", "shingles"), "class_b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    sim = (common / (F.size("shingles_a") + F.size("shingles_b") - common)).alias("similarity")
    return both.select("class_a", "class_b", sim).where(F.col("similarity") >= threshold)


class NearDuplicates:
    """Classes of equal shingle sets and the links between them."""

    def __init__(self, records: DataFrame, key: str = "id", shingle: int = 5, threshold: float = 0.8, short: bool = False) -> None:
        self.key = key
        rows, bands = banding(threshold)
        signed = materialise(signatures(distinct_texts(records, key, "text"), key, shingle, rows, bands, short))
        self.members = signed.select(key, "class_hash")
        self.classes = signed.where("bands is not null").drop(key)
        self.links = materialise(similar_classes(self.classes, threshold, max(rows * bands, SAMPLES)))

    def pairs(self) -> DataFrame:
        """(key_a, key_b): every pair of keys that are versions of each other, key_a < key_b."""
        k = self.key
        m = self.members
        x, y = m.select(F.col(k).alias("u"), "class_hash"), m.select(F.col(k).alias("v"), "class_hash")
        within = x.join(y, "class_hash").where("u < v").select("u", "v")
        across = self.links.join(x.withColumnRenamed("class_hash", "class_a"), "class_a").join(y.withColumnRenamed("class_hash", "class_b"), "class_b").select("u", "v")
        return within.unionByName(across).select(F.least("u", "v").alias(f"{k}_a"), F.greatest("u", "v").alias(f"{k}_b"))

    def versions(self) -> DataFrame:
        """One row per key: its class, the group (least class reachable over links) and its number of links."""
        from corpusloom.llm.components import components

        copies = self.members.groupBy("class_hash").agg(F.count("*").alias("copies"))
        ends = self.links.select(F.col("class_a").alias("class_hash"), F.col("class_b").alias("other")).unionByName(self.links.select(F.col("class_b").alias("class_hash"), F.col("class_a").alias("other")))
        linked = ends.join(copies.withColumnRenamed("class_hash", "other"), "other").groupBy("class_hash").agg(F.sum("copies").alias("linked"))
        group = components(self.links.select(F.col("class_a").alias("src"), F.col("class_b").alias("dst")))
        return (
            self.members.join(copies, "class_hash").join(linked, "class_hash", "left").join(group.withColumnRenamed("node", "class_hash"), "class_hash", "left")
            .select(self.key, F.col("class_hash").alias("class_id"), F.coalesce("component", "class_hash").alias("group_id"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"))
        )
