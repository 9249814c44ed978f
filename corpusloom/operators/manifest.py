"""The download manifest as an append log: latest state, look-ups, what is still to be fetched, status totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(log: DataFrame, keys: tuple[str, ...] = ("source", "item_id"), at: str = "recorded_at") -> DataFrame:
    """The last recorded row of every item: a grouped maximum, which combines before the shuffle. Ties take the greatest row."""
    rest = [c for c in log.columns if c not in (*keys, at)]
    best = log.groupBy(*keys).agg(F.max(F.struct(at, *rest)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in (at, *rest)])


def from_json_items(df: DataFrame, column: str = "items") -> DataFrame:
    """Rows of a manifest read from JSON: map<item id, attributes> -> (item_id, attributes..)."""
    return df.select(F.explode(column).alias("item_id", "_a")).select("item_id", "_a.*")


def append_downloaded(items: DataFrame, at) -> DataFrame:
    """Rows for the log that mark items as downloaded at a time (a timestamp column or literal)."""
    return items.withColumns({"status": F.lit("downloaded"), "download_date": F.lit(at), "recorded_at": F.lit(at)})


def append_failed(items: DataFrame, at, error: str = "error") -> DataFrame:
    return items.withColumns({"status": F.lit("failed"), "error": F.col(error), "failed_date": F.lit(at), "recorded_at": F.lit(at)})


def pending(candidates: DataFrame, state: DataFrame, keys: tuple[str, ...] = ("source", "item_id")) -> DataFrame:
    """Candidates without a downloaded entry; failed ones are tried again."""
    return candidates.join(state.where("status = 'downloaded'").select(*keys).distinct(), list(keys), "left_anti")


def look_up(files: DataFrame, state: DataFrame, path: str = "path", key: str = "item_id", legacy: bool = False) -> DataFrame:
    """Files (source, path) with the attributes of their item.

    The item is the longest leading part of the path (its last component without extension) that the manifest of the source
    knows. ``legacy`` looks at the first component only, then at it without extension."""
    parts = F.split(path, "/")
    stem = lambda c: F.regexp_replace(c, r"\.[^./]+$", "")
    if legacy:
        tries = F.array(F.element_at(parts, 1), stem(F.element_at(parts, 1)))
    else:
        full = F.transform(F.reverse(F.sequence(F.lit(1), F.size(parts))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
        tries = F.flatten(F.transform(full, lambda p: F.array(p, stem(p))))
    tried = files.select("source", path).distinct().select("source", path, F.posexplode(tries).alias("_rank", key))
    attrs = [c for c in state.columns if c not in ("source", key)]
    hit = tried.join(state, ["source", key]).groupBy("source", path).agg(F.min(F.struct("_rank", F.col(key), *attrs)).alias("_m"))
    return files.join(hit, ["source", path], "left").select(*files.columns, F.col(f"_m.{key}").alias(f"manifest_{key}"), *[F.col(f"_m.{c}").alias(f"manifest_{c}") for c in attrs])


def status_rollup(state: DataFrame) -> DataFrame:
    """(source, downloaded, failed) per source and, as ``TOTAL``, over all."""
    rolled = state.rollup("source").agg(F.count_if(F.col("status") == "downloaded").alias("downloaded"), F.count_if(F.col("status") == "failed").alias("failed"), F.grouping("source").alias("_g"))
    return rolled.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("source")).alias("source"), "downloaded", "failed")
