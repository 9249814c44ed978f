"""Problem 5: token counts per document and totals by source, tradition and language.

Every worker loads the tokenizer once and counts whole Arrow batches: all words of a batch are numbered, every distinct one is read
once, and counts are added up by text with array operations. Two tokenizers are offered: the vocabulary table that
sizes refer to (greedy longest pieces; a word's count is kept, so a word is read once per worker), and any public tokenizer
file for the ``tokenizers`` library, whose path is a parameter. Counts are exact. Totals are summed per slice before the cube
is formed, so the cube expands slices, not documents.

Defined cases: null and blank texts give no row; ids count once; labels missing or unusable count under ``unknown``; all
spellings of a label count under one name; an empty table gives an empty result; extra columns are ignored; a text of any
length is read whole.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import WORD, distinct_texts, language_code, slug, spread

_OTHER = re.compile(r"[^\w\s]|_")
#: The vocabulary is sent to all workers; a larger one is refused.
MOST_PIECES = 2_000_000


class PieceCounter(dict):
    """word -> number of pieces; fills itself on demand."""

    def __init__(self, pieces: set[str]) -> None:
        super().__init__()
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=0)

    def __missing__(self, word: str) -> int:
        n, a = 0, 0
        while a < len(word):
            mark = "##" if a else ""
            for b in range(min(len(word), a + self.longest), a, -1):
                if mark + word[a:b] in self.pieces:
                    break
            else:
                n = 1
                break
            n, a = n + 1, b
        if len(self) > 1_000_000:
            self.clear()
        self[word] = n
        return n

    def count(self, text: str) -> int:
        low = text.lower()
        return sum(map(self.__getitem__, WORD.findall(low))) + len(_OTHER.findall(low))


    def count_batch(self, texts: list[str], step: int = 4_000_000) -> np.ndarray:
        """Tokens of each text; texts are joined up to about ``step`` characters at a time."""
        out = np.zeros(len(texts), np.int64)
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b]) <= step):
                size, b = size + len(texts[b]), b + 1
            low = [t.lower() for t in texts[a:b]]
            found = [WORD.findall(t) for t in low]
            ids, distinct = pd.factorize(np.array([w for f in found for w in f], dtype=object))
            pieces = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
            owner = np.repeat(np.arange(b - a), [len(f) for f in found])
            out[a:b] = np.bincount(owner, weights=pieces[ids], minlength=b - a).astype(np.int64) if len(ids) else 0
            out[a:b] += [len(_OTHER.findall(t)) for t in low]
            a = b
        return out


_COUNTERS: dict = {}


def counter_of(shared) -> PieceCounter:
    """The counter of a broadcast vocabulary, made once per worker."""
    if id(shared.value) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[id(shared.value)] = PieceCounter(shared.value)
    return _COUNTERS[id(shared.value)]


def read_pieces(vocab: DataFrame) -> set[str]:
    """The vocabulary's pieces, after a check of their number."""
    n = vocab.count()
    if n > MOST_PIECES:
        raise ValueError(f"a vocabulary of {n} pieces is too large to send to every worker")
    return {r["piece"] for r in vocab.select("piece").where("piece is not null").collect()}


def count_tokens(texts: DataFrame, key: str, pieces: set[str]) -> DataFrame:
    """(all columns but text, n_tokens) under the vocabulary table."""
    rest = [f for f in texts.schema.fields if f.name != "text"]
    schema = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ",n_tokens long"
    shared = texts.sparkSession.sparkContext.broadcast(pieces)

    def count(batches):
        counter = counter_of(shared)
        for pdf in batches:
            yield pdf.drop(columns="text").assign(n_tokens=counter.count_batch(pdf["text"].tolist()))

    return texts.mapInPandas(count, schema)


_TOKENIZERS: dict = {}


def count_public_tokens(texts: DataFrame, key: str, path: str) -> DataFrame:
    """(all columns but text, n_tokens) under a tokenizer file of the ``tokenizers`` library; ``path`` must be readable on the workers."""
    rest = [f for f in texts.schema.fields if f.name != "text"]
    schema = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ",n_tokens long"

    def count(batches):
        from tokenizers import Tokenizer

        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = Tokenizer.from_file(path)
            _TOKENIZERS[path].encode_special_tokens = True
        tok = _TOKENIZERS[path]
        for pdf in batches:
            n: list[int] = []
            texts_ = pdf["text"].tolist()
            for s in range(0, len(texts_), 128):
                n += [len(e) for e in tok.encode_batch_fast(texts_[s : s + 128], add_special_tokens=False)]
            yield pdf.drop(columns="text").assign(n_tokens=pd.Series(n, index=pdf.index, dtype="int64"))

    return texts.mapInPandas(count, schema)


def documents_with_slices(records: DataFrame, key: str = "id") -> DataFrame:
    unknown = F.lit("unknown")
    clean = records.select(
        key, "text", F.coalesce(slug(F.col("source")), unknown).alias("source"), F.coalesce(slug(F.col("tradition")), unknown).alias("tradition"),
        F.coalesce(language_code(F.col("language")), unknown).alias("language"),
    )
    return spread(distinct_texts(clean, key, "text", "source", "tradition", "language"), key)


def token_cube(counted: DataFrame) -> DataFrame:
    """Totals for every combination of source, tradition and language and all their roll-ups; ``(all)`` marks a rolled-up label."""
    slices = counted.groupBy("source", "tradition", "language").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"))
    names = ("source", "tradition", "language")
    cube = slices.cube(*names).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"), *[F.grouping(c).alias(f"_{c}") for c in names])
    return cube.select(*[F.when(F.col(f"_{c}") == 1, "(all)").otherwise(F.col(c)).alias(c) for c in names], "documents", "tokens")
