"""Incremental forms of the batch operators as structured streams (an extension; the batch forms are in operators)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import content_hash
from corpusloom.operators.embedding import embed


def stream_parquet(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def deduplicated(stream: DataFrame, at: str, text: str = "text", delay: str = "7 days", **how) -> DataFrame:
    """First arrival of each content hash within the watermark; state older than it is let go."""
    return stream.withColumn("content_hash", content_hash(F.col(text), **how)).withWatermark(at, delay).dropDuplicatesWithinWatermark(["content_hash"])


def arrivals(stream: DataFrame, at: str, by: str, window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Counts per event-time window and label; late rows count until the watermark has passed."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, window), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def embed_new(stream: DataFrame, out: str, checkpoint: str, load: Callable | None = None) -> StreamingQuery:
    """Embed what is new since the last run and stop; the checkpoint remembers what has been read."""
    return embed(stream, load=load).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
