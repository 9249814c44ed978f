"""Top terms of clusters by smoothed tf-idf, cluster sizes."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TERM = r"[\p{L}\p{N}_]{2,}"


def stop_words() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def top_terms(df: DataFrame, cluster: str = "cluster", text: str = "text", top_n: int = 5, vocabulary: int = 1000, stop: list[str] | None = None) -> DataFrame:
    """(cluster, rank, term, weight): tf x (ln((1+n)/(1+df)) + 1), rows scaled to length one.

    Noise (-1) and null clusters leave. The vocabulary holds the ``vocabulary`` most frequent terms, ties by term; equal
    weights rank by term, descending. Counting by (cluster, term) replaces joining a cluster's texts."""
    stop = stop_words() if stop is None else stop
    words = df.where(F.col(cluster).isNotNull() & (F.col(cluster) != -1) & F.col(text).isNotNull()).select(cluster, F.explode(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))).alias("term"))
    tf = words.where(~F.col("term").isin(stop)).groupBy(cluster, "term").agg(F.count("*").alias("tf"))
    n = df.where(F.col(cluster).isNotNull() & (F.col(cluster) != -1)).select(cluster).distinct().agg(F.count("*").alias("n"))
    vocab = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "term").limit(vocabulary)
    kept = tf.join(F.broadcast(vocab.select("term", "df")), "term").join(F.broadcast(n))  # vocabulary rows, one row
    w = kept.withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    length = w.groupBy(cluster).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    scaled = w.join(length, cluster).select(cluster, "term", (F.col("w") / F.col("l")).alias("weight"))
    rank = F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc(F.round("weight", 9)), F.desc("term")))
    return scaled.withColumn("rank", rank).where(F.col("rank") <= top_n).select(cluster, "rank", "term", "weight")


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("size"))


def cluster_totals(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(clusters, noise, unassigned)."""
    sizes = df.groupBy(cluster).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count_if(F.col(cluster).isNotNull() & (F.col(cluster) != -1)).alias("clusters"),
        F.coalesce(F.sum(F.when(F.col(cluster) == -1, F.col("n"))), F.lit(0)).alias("noise"),
        F.coalesce(F.sum(F.when(F.col(cluster).isNull(), F.col("n"))), F.lit(0)).alias("unassigned"),
    )
