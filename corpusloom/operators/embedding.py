"""Embedding as a pluggable model over Arrow batches, and its incremental form."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from corpusloom.operators.gates import only_new

Model = Callable[[list[str]], np.ndarray]


def hashed_words(dimensions: int = 64) -> Callable[[], Model]:
    """The default model: signed hashed word counts. A stand-in that needs no files, not a trained embedding."""

    def load() -> Model:
        seat: dict[str, tuple[int, float]] = {}

        def embed(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimensions))
            for i, t in enumerate(texts):
                for w in (t or "").lower().split():
                    if w not in seat:
                        if len(seat) > 1_000_000:
                            seat.clear()
                        h = zlib.crc32(w.encode())
                        seat[w] = (h % dimensions, 1.0 if h >> 16 & 1 else -1.0)
                    k, s = seat[w]
                    out[i, k] += s
            return out

        return embed

    return load


def embed(df: DataFrame, text: str = "text", load: Callable[[], Model] | None = None, batch: int = 128, out: str = "vector") -> DataFrame:
    """Adds a float vector of length one (all zero for a text without words). The model is loaded once per task."""
    load = load or hashed_words()
    schema = StructType([f for f in df.schema.fields if f.name != out] + [StructField(out, ArrayType(FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows: list = []
            texts = pdf[text].fillna("").tolist()
            for s in range(0, len(texts), batch):
                v = np.asarray(model(texts[s : s + batch]), dtype=np.float64)
                n = np.linalg.norm(v, axis=1, keepdims=True)
                rows += list((v / np.where(n > 0, n, 1)).astype(np.float32))
            yield pdf.assign(**{out: rows})[schema.names]

    return df.mapInPandas(run, schema)


def embed_incremental(chunks: DataFrame, done: DataFrame, key: str = "id", **how) -> DataFrame:
    """Earlier rows and the newly embedded chunks of documents without any; columns are matched by name."""
    return done.unionByName(embed(only_new(chunks, done, key), **how), allowMissingColumns=True)


def _finished(path: str) -> bool:
    from corpusloom.sources.sinks import read_file

    try:
        read_file(f"{path}/_SUCCESS")
    except OSError:
        return False
    return True


def embed_in_parts(chunks: DataFrame, path: str, key: str = "chunk_id", parts: int = 64, force: bool = False, **how) -> list[int]:
    """Embed and write ``chunks`` part by part below ``path`` (``part=0..``); the parts written now.

    A part is the rows of one remainder of the key's hash and is written by a job of its own, whose success mark says that it is whole: a
    run that was broken off goes on with the parts that lack the mark. ``force`` makes all of them again."""
    number = F.pmod(F.xxhash64(key), F.lit(parts))
    todo = [i for i in range(parts) if force or not _finished(f"{path}/part={i}")]
    for i in todo:
        embed(chunks.where(number == i), **how).write.mode("overwrite").option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/part={i}")
    return todo


def coverage(embedded: DataFrame, key: str = "id") -> DataFrame:
    """(documents, chunks)."""
    per = embedded.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(F.count(key).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"))


def model_info(name: str, dimensions: int, device: str = "cpu") -> str:
    return json.dumps({"model": name, "dimensions": dimensions, "device": device})
