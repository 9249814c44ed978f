"""The corpus build as one plan: extract, normalise, gate, label, deduplicate, export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import detect_language, normalize_text
from corpusloom.operators.dedup import mark_duplicates
from corpusloom.operators.export import export
from corpusloom.operators.gates import quality_outcome
from corpusloom.session import materialise, parallelism
from corpusloom.sources.files import decode
from corpusloom.sources.html import html_page


def extract(files: DataFrame, pdf_texts: DataFrame | None = None) -> DataFrame:
    """(id, source, rel, ext, text, chapters) by extension. Each kind is a branch of its own, so that no costly reader sees
    rows of another kind; PDF texts (path, text) come from a plugged-in reader."""
    pages = files.where(F.col("ext").isin(".html", ".htm")).withColumn("_p", html_page(decode())).select("id", "source", "rel", "ext", F.col("_p.text").alias("text"), F.col("_p.chapters").alias("chapters"))
    none = F.array().cast("array<string>").alias("chapters")
    plain = files.where(F.col("ext") == ".txt").select("id", "source", "rel", "ext", decode().alias("text"), none)
    out = pages.unionByName(plain)
    if pdf_texts is not None:
        out = out.unionByName(files.where(F.col("ext") == ".pdf").join(pdf_texts.select("path", "text"), "path").select("id", "source", "rel", "ext", "text", none))
    return out


def process(records: DataFrame, key: str = "id", detector=None, fold: bool = True) -> DataFrame:
    """Adds normalised text, ``language``, ``char_count``, ``outcome`` (too_short, garbled, duplicate, processed) and
    ``duplicate_of``. Rows are never dropped here; an outcome says what became of each.

    The normalised records are written once (a checkpoint), since the steps after it read them several times."""
    # spread first: the rows may come from a small shuffle or scan in one partition, and the text steps are the costly ones
    records = records.repartition(parallelism(records.sparkSession), key)
    clean = records.withColumn("text", normalize_text(F.col("text"), fold=fold))
    done = materialise(clean.withColumns({"outcome": quality_outcome(F.col("text")), "language": detect_language(F.col("text"), detector), "char_count": F.length("text").cast("long")}))
    order = [F.col(c) for c in ("source", "rel") if c in records.columns]
    marks = mark_duplicates(done.where("outcome = 'kept'"), key, order)
    out = done.join(marks.select(key, "duplicate_of"), key, "left")
    return out.withColumn("outcome", F.when(F.col("outcome") != "kept", F.col("outcome")).when(F.col("duplicate_of").isNotNull(), "duplicate").otherwise("processed"))


def outcome_counts(processed: DataFrame) -> DataFrame:
    return processed.groupBy("outcome").agg(F.count("*").alias("n"))


def build_corpus(records: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(corpus, misc) of the processed records."""
    return export(process(records, key).where("outcome = 'processed'"))
