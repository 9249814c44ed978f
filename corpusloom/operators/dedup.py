"""Exact duplicates by content hash. Only (hash, order, key) is shuffled; the winners' rows are joined back by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import content_hash


def mark_duplicates(df: DataFrame, key: str, order: list[Column], text: str = "text", prefix: int = 2000, lowercase: bool = True) -> DataFrame:
    """(key, content_hash, duplicate_of): null for the first of each hash by ``order`` then key, else the key of that first one.

    The first is found by a grouped minimum, which combines before the shuffle, and joined back, so that a hash held by a
    third of all rows never stands in one task. Null texts are no duplicates of each other. ``order`` sorts ascending."""
    hashed = df.select(key, content_hash(F.col(text), prefix, lowercase).alias("content_hash"), F.struct(*order, F.col(key)).alias("_o"))
    first = hashed.where("content_hash is not null").groupBy("content_hash").agg(F.min("_o")[key].alias("_first"), F.count("*").alias("_n"))
    marked = hashed.join(first.where("_n > 1"), "content_hash", "left")
    return marked.select(key, "content_hash", F.when(F.col(key) != F.col("_first"), F.col("_first")).alias("duplicate_of"))


def keep_first(df: DataFrame, key: str, order: list[Column], text: str = "text", prefix: int = 2000, lowercase: bool = True) -> DataFrame:
    """The rows that come first in their hash, in the order of arrival; null texts all stay.

    One aggregate carries the winner's key of each hash, so a text is hashed once; the rows are then met by key."""
    hashed = df.select(key, content_hash(F.col(text), prefix, lowercase).alias("content_hash"), F.struct(*order, F.col(key)).alias("_o"))
    alone = F.when(F.col("content_hash").isNull(), F.col(key))  # a null text is a group of its own
    first = hashed.groupBy("content_hash", alone.alias("_k")).agg(F.min("_o")[key].alias(key)).select(key)
    return df.join(first, key, "left_semi")


def keep_longest(df: DataFrame, key: str, size: str = "char_count", **how) -> DataFrame:
    """The longest row of each hash; of equally long ones the least key."""
    how = {"prefix": 5000, "lowercase": False} | how
    return keep_first(df, key, [-F.coalesce(F.col(size), F.lit(-1))], **how)


def duplicate_count(df: DataFrame, key: str, **how) -> DataFrame:
    """(rows, distinct_hashes, duplicates)."""
    text = how.pop("text", "text")
    h = df.select(content_hash(F.col(text), **how).alias("h")).where("h is not null").groupBy("h").agg(F.count("*").alias("n"))
    return h.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_hashes"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def against_existing(df: DataFrame, stored: DataFrame, key: str, **how) -> DataFrame:
    """Rows whose hash is not among the stored ones (a table with a ``content_hash`` column)."""
    text = how.pop("text", "text")
    h = df.select(key, content_hash(F.col(text), **how).alias("content_hash"))
    new = h.join(stored.select("content_hash").distinct(), "content_hash", "left_anti").select(key)
    return df.join(new, key, "left_semi")
