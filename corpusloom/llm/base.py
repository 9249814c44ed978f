"""What the training-data operators share: word definition, grouping inside partitions, label names."""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ensure_checkpoint_dir, materialise, table  # noqa: F401

#: Words are the maximal runs of letters and digits of a lower-cased text.
WORD = re.compile(r"[^\W_]+")
JAVA_WORD = r"[\p{L}\p{N}]+"


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def not_blank(c: Column) -> Column:
    """True for texts that hold at least one non-blank character; null texts are not."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def distinct_texts(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row per key of the rows with a text; re-delivered rows carry equal text, so any may stand for all."""
    return df.select(key, *columns).where(F.col(key).isNotNull() & not_blank(F.col("text"))).dropDuplicates([key])


def iter_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Groups of a partition that is sorted by ``key``, one at a time, without Spark's cost per group.

    Memory is bounded by the largest group plus one Arrow batch."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[key].to_numpy()
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        edges = [0, *cuts.tolist(), len(pdf)]
        for a, b in zip(edges[:-1], edges[1:]):
            part = pdf.iloc[a:b]
            if held and held[-1][key].iloc[0] != k[a]:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver find out which finished steps nothing refers to any more, so that their shuffle files leave the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Up to so many narrow rows (ids and numbers, no texts or vectors) are sent to all executors.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A table that is written already, marked for broadcast if it has at most so many rows; beyond that it is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, key: str, least: int | None = None) -> DataFrame:
    """Spread rows over the tasks for a Python stage: the parquet scan may have put a small file into one split."""
    return df.repartition(least or parallelism(df.sparkSession), key)


def balanced(df: DataFrame, key: str) -> DataFrame:
    """A scan (a plan without a shuffle) as it is if it has enough partitions for all cores, else spread by key.

    Large tables come in many splits and need no shuffle; a small table may come in one."""
    given = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if given >= df.sparkSession.sparkContext.defaultParallelism else df.repartition(parallelism(df.sparkSession), key)


#: Language names as the tables spell them, by code.
LANGUAGE_NAMES = {
    "en": ("en", "eng", "english", "englisch", "anglais", "ingles", "inglés", "inglese"),
    "la": ("la", "lat", "latin", "latina", "latein", "lateinisch", "latino"),
    "de": ("de", "deu", "ger", "german", "deutsch", "allemand", "tedesco"),
    "fr": ("fr", "fra", "fre", "french", "francais", "français", "französisch"),
    "it": ("it", "ita", "italian", "italiano", "italienisch", "italien"),
    "es": ("es", "spa", "spanish", "espanol", "español", "castellano", "espagnol", "spanisch"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands"),
}
LANGUAGES = ("en", "la", "de", "fr", "it", "es")


def language_code(c: Column) -> Column:
    """The code a label stands for in any spelling; null where it is missing or unusable."""
    head = F.regexp_extract(F.lower(F.trim(c)), r"^([\p{L}]+)", 1)
    names = F.create_map(*[F.lit(x) for code, all_ in LANGUAGE_NAMES.items() for name in all_ for x in (name, code)])
    return F.try_element_at(names, head)


def slug(c: Column) -> Column:
    """One name for a source or tradition in all its spellings: lower case, single hyphens; null if blank."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[\s_\-]+", "-")
    return F.when(s != "", s)
