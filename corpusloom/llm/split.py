"""Problem 3: cut oversized texts into ordered pieces within a limit, at topic boundaries, with a stated overlap.

Lexical cohesion: at every sentence or line end the words of the blocks before and after it are compared by cosine; the depth
of the similarity valley marks topic boundaries. Within each size window the deepest valley is taken, paragraph ends counting
as deeper. A piece begins with the last ``overlap`` code points (cut at a blank) of the one before. The similarity of blocks
is summed from running word counts, so a text costs time in proportion to its length.

Defined cases: null texts give no row; a text within the limit gives none unless ``keep_small`` is set, then it is one piece; a
text without natural places is cut at a blank, without blanks at the limit; repeated rows of a key count once; an empty table
gives an empty result; ties between valleys go to the later place, which makes pieces longer. Lengths are code points. Joining
``text[overlap_chars:]`` of the pieces in order gives back the text exactly.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import WORD, spread

_PLACE = re.compile(r"\n[ \t]*\n\s*|\n|(?<=[.!?;:])[\"'”’)]*\s+|(?<=,)\s+")


def places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets at which a piece may begin and how natural each is (paragraph 3, sentence 2, line 1, clause 0.5)."""
    at, rank = [], []
    for m in _PLACE.finditer(text):
        gap, before = m.group(), text[m.start() - 1 : m.start()]
        at.append(m.end())
        rank.append(3.0 if gap.count("\n") > 1 else 2.0 if before in tuple(".!?\"'”’") else 1.0 if "\n" in gap else 0.5)
    return np.array(at, dtype=np.int64), np.array(rank)


def valley_depths(text: str, at: np.ndarray, width: int = 60) -> np.ndarray:
    """Depth of the similarity valley at each place: how far cohesion rises on both sides of it."""
    found = [(m.start(), m.group()) for m in WORD.finditer(text.lower())]
    if not found or not len(at):
        return np.zeros(len(at))
    starts = np.array([a for a, _ in found])
    seq = [w for _, w in found]
    cut = np.searchsorted(starts, at)
    sim = np.zeros(len(at))
    left: Counter = Counter()
    right: Counter = Counter()
    lo, mid, hi = 0, 0, 0
    dot, nl, nr = 0.0, 0.0, 0.0

    def move(side: Counter, other: Counter, w: str, by: int) -> tuple[float, float]:
        old = side[w]
        side[w] = old + by
        return float(by * other[w]), float((old + by) ** 2 - old * old)

    for i, c in enumerate(cut.tolist()):
        a, b = max(0, c - width), min(len(seq), c + width)
        while hi < b:
            d, n = move(right, left, seq[hi], 1)
            dot, nr, hi = dot + d, nr + n, hi + 1
        while mid < c:
            w = seq[mid]
            d, n = move(right, left, w, -1)
            dot, nr = dot + d, nr + n
            d, n = move(left, right, w, 1)
            dot, nl, mid = dot + d, nl + n, mid + 1
        while lo < a:
            d, n = move(left, right, seq[lo], -1)
            dot, nl, lo = dot + d, nl + n, lo + 1
        sim[i] = dot / np.sqrt(nl * nr) if nl > 0 and nr > 0 else 0.0
    rise_l = np.maximum.accumulate(sim) if len(sim) < 3 else np.array([sim[max(0, i - 12) : i + 1].max() for i in range(len(sim))])
    rise_r = np.array([sim[i : i + 13].max() for i in range(len(sim))])
    return (rise_l - sim) + (rise_r - sim)


def cut_points(text: str, limit: int, overlap: int) -> list[int]:
    """Offsets at which pieces begin (without their overlap); the first is 0."""
    at, rank = places(text)
    depth = valley_depths(text, at) + 0.12 * rank
    out, a = [0], 0
    while True:
        room = limit - (overlap if a else 0)
        if len(text) - a <= room:
            return out
        lo, hi = np.searchsorted(at, a + max(1, room // 2)), np.searchsorted(at, a + room, side="right")
        if lo >= hi:
            lo = np.searchsorted(at, a, side="right")
        if lo < hi:
            best = hi - 1 - int(np.argmax(depth[lo:hi][::-1]))
            a = int(at[best])
        else:
            blank = max(text.rfind(" ", a + 1, a + room), text.rfind("\t", a + 1, a + room))
            a = blank + 1 if blank > a else a + room
        out.append(a)


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, overlap_chars) of the pieces; ``text[start:end]`` is the piece, its first overlap_chars repeat the one before."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be at least 0 and less than half of the limit")
    begins = cut_points(text, limit, overlap)
    out = []
    for i, a in enumerate(begins):
        back = 0
        if i and overlap:
            s = max(begins[i - 1], a - overlap)
            blank = re.search(r"\s\S", text[s:a])
            s = s + blank.start() + 1 if blank and s > begins[i - 1] and not text[s - 1].isspace() else s
            back = a - s
        out.append((a - back, begins[i + 1] if i + 1 < len(begins) else len(text), back))
    return out


def split_oversized(df: DataFrame, key: str, limit: int, overlap: int, keep_small: bool = False, text: str = "text") -> DataFrame:
    """(key, piece_no, n_pieces, start, overlap_chars, text): only oversized texts leave the JVM."""
    rows = df.select(F.col(key), F.col(text).alias("text")).where(F.col("text").isNotNull() & F.col(key).isNotNull())
    large = spread(rows.where(F.length("text") > limit).dropDuplicates([key]), key)

    def cut(batches):
        for pdf in batches:
            out = []
            for k, t in zip(pdf[key], pdf["text"]):
                found = split_text(t, limit, overlap)
                out += [(k, i, len(found), a, back, t[a:b]) for i, (a, b, back) in enumerate(found)]
            yield pd.DataFrame(out, columns=[key, "piece_no", "n_pieces", "start", "overlap_chars", "text"])

    kind = df.schema[key].dataType.simpleString()
    pieces = large.mapInPandas(cut, f"`{key}` {kind}, piece_no int, n_pieces int, start int, overlap_chars int, text string")
    if keep_small:
        zero = F.lit(0).alias
        small = rows.where(F.length("text") <= limit).dropDuplicates([key])
        pieces = pieces.unionByName(small.select(key, zero("piece_no"), F.lit(1).alias("n_pieces"), zero("start"), zero("overlap_chars"), "text"))
    return pieces
