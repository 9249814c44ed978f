"""Pick the better of two versions of a record: the plain one or its ``_djvu`` sibling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import quality_score

SUFFIX = "_djvu"


def compare_versions(df: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """(base, plain_score, djvu_score, winner): winner is ``pdf``, ``djvu`` or ``tie``; a tie keeps the djvu version.

    Only scores are joined, not texts; keys are taken as unique."""
    scored = df.select(F.col(key).alias("k"), quality_score(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    djvu = scored.where(F.endswith(F.col("k"), F.lit(SUFFIX))).select(F.replace("k", F.lit(SUFFIX), F.lit("")).alias("base"), F.col("k").alias("djvu_key"), F.col("score").alias("djvu_score"))
    plain = scored.select(F.col("k").alias("base"), F.col("score").alias("plain_score"))
    winner = F.when(F.col("plain_score") > F.col("djvu_score"), "pdf").when(F.col("djvu_score") > F.col("plain_score"), "djvu").otherwise("tie")
    return plain.join(djvu, "base").select("base", "djvu_key", "plain_score", "djvu_score", winner.alias("winner"))


def pick_best(df: DataFrame, key: str = "id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept, overflow): records without their losing version, and the losers."""
    pairs = compare_versions(df, key, text)
    losers = pairs.select(F.when(F.col("winner") == "pdf", F.col("djvu_key")).otherwise(F.col("base")).alias(key))
    return df.join(losers, key, "left_anti"), df.join(losers, key, "left_semi")


def winner_counts(df: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    return compare_versions(df, key, text).groupBy("winner").agg(F.count("*").alias("n"))
