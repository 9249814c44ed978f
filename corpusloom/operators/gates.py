"""Row gates that sort records instead of failing jobs: quality, topic, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import is_garbled, is_off_topic, strip


def quality_outcome(text: Column, min_length: int = 200, max_ratio: float = 0.10) -> Column:
    """``too_short``, ``garbled`` or ``kept``; a null text is too short."""
    return F.when(F.coalesce(F.length(strip(text)), F.lit(0)) < min_length, "too_short").when(is_garbled(text, max_ratio), "garbled").otherwise("kept")


def with_outcome(df: DataFrame, text: str = "text", min_length: int = 200, max_ratio: float = 0.10) -> DataFrame:
    return df.withColumn("outcome", quality_outcome(F.col(text), min_length, max_ratio))


def split_off_topic(df: DataFrame, title: str = "title") -> tuple[DataFrame, DataFrame]:
    """(kept, misc)."""
    flagged = df.withColumn("_off", is_off_topic(F.col(title)))
    return flagged.where(~F.col("_off")).drop("_off"), flagged.where("_off").drop("_off")


def choose_ocr(text: Column, page_count: Column, ocr: Column, no_ocr: bool = False, max_ratio: float = 0.10) -> tuple[Column, Column]:
    """(text, ocr_used): the recognised text if the extracted one is scanned or garbled and shorter than it."""
    if no_ocr:
        return text, F.lit(False)
    need = is_scanned(F.length(strip(text)), page_count) | is_garbled(text, max_ratio)
    longer = F.length(strip(ocr)) > F.length(strip(text))
    return F.when(need & longer, ocr).otherwise(text), need


def is_scanned(chars: Column, pages: Column) -> Column:
    return F.coalesce(chars, F.lit(0)) < 10 * pages


def only_new(df: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows whose key has no output yet; ``force`` takes all."""
    return df if force else df.join(done.select(key).distinct(), key, "left_anti")
