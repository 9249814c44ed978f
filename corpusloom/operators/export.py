"""Typed corpus projection, its summaries and the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import coerce_string
from corpusloom.operators.dedup import keep_longest
from corpusloom.operators.gates import split_off_topic

DEFAULTS = {"id": "", "title": "", "author": "unknown", "tradition": "unknown", "source": "", "source_url": "", "language": "en", "file_type": ""}
COLUMNS = ("id", "text", "title", "author", "tradition", "source", "source_url", "language", "file_type", "ocr_used", "char_count")


def typed_corpus(df: DataFrame) -> DataFrame:
    """The eleven corpus columns with their types and defaults; null texts leave."""
    kinds = dict(df.dtypes)
    cols = {c: coerce_string(F.col(c), d, kinds[c].startswith("array")) if c in kinds else F.lit(d) for c, d in DEFAULTS.items()}
    cols["text"] = F.col("text")
    cols["ocr_used"] = F.coalesce(F.col("ocr_used"), F.lit(False)) if "ocr_used" in kinds else F.lit(False)
    size = F.length("text").cast("long")
    cols["char_count"] = F.coalesce(F.col("char_count").cast("long"), size) if "char_count" in kinds else size
    return df.where(F.col("text").isNotNull()).select(*[cols[c].alias(c) for c in COLUMNS])


def export(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corpus, misc): off-topic records set aside, then the longest of equal texts, typed."""
    kept, misc = split_off_topic(df)
    return keep_longest(typed_corpus(kept), "id"), misc


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """(column, documents, chars), most documents first, then by name."""
    return df.groupBy(column).agg(F.count("*").alias("documents"), F.sum("char_count").alias("chars")).orderBy(F.desc("documents"), column)


def summary(corpus: DataFrame, duplicates: int, misc: int, size_mb: float | None = None) -> dict:
    """The JSON summary; sources and languages are few, their counts come to the driver."""
    row = corpus.agg(F.count("*").alias("n"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("c")).first()
    per = lambda c: {r[c]: r["documents"] for r in counts_by(corpus, c).collect()}
    return {
        "total_documents": row["n"], "total_chars": row["c"], "file_size_mb": size_mb, "compression": "zstd", "sources": per("source"), "languages": per("language"),
        "columns": list(COLUMNS), "duplicates_removed": duplicates, "off_topic_moved_to_misc": misc,
    }


def write_corpus(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    corpus.select(*COLUMNS).write.mode(mode).option("compression", "zstd").parquet(path)
