"""Files as tables: raw scans, text with JSON sidecars, page texts of PDF files, and the sinks beside the corpus itself."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_EXTENSIONS = (".html", ".htm", ".txt")
EXTENSIONS = (*TEXT_EXTENSIONS, ".pdf")

SIDECAR = "id string, title string, author string, tradition string, source string, source_url string, file_type string, ocr_used boolean, language string, chapters array<string>, char_count long"
ERROR = "timestamp string, stage string, source string, item_id string, error_type string, traceback string"


def raw_files(spark: SparkSession, root: str, skip_pdf: bool = False) -> DataFrame:
    """(path, ext, rel, source, stem_id, content) below ``root``/<source>/..; manifests and other extensions leave before reading."""
    wanted = TEXT_EXTENSIONS if skip_pdf else EXTENSIONS
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    path = F.regexp_replace("path", r"^\w+:/+", "")
    rel = F.expr(f"substring(regexp_replace(path, '^[a-z0-9]+:/+', ''), {len(base) + 2})")
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    out = df.select("path", ext.alias("ext"), rel.alias("_r"), "content").where(F.col("ext").isin(*wanted) & ~F.endswith(F.col("path"), F.lit("/manifest.json")))
    source = F.substring_index("_r", "/", 1)
    inner = F.expr("substring(_r, length(substring_index(_r, '/', 1)) + 2)")
    ident = F.concat(source, F.lit("_"), F.replace(F.regexp_replace(inner, r"\.[^./]+$", ""), F.lit("/"), F.lit("_")))
    return out.select("path", "ext", inner.alias("rel"), source.alias("source"), ident.alias("id"), "content")


def decode(content_column: str = "content"):
    """Bytes as UTF-8, invalid sequences as U+FFFD."""
    return F.expr(f"make_valid_utf8(cast({content_column} as string))")


def _stem(column: str):
    return F.regexp_replace(F.regexp_extract(column, r"([^/]+)$", 1), r"\.[^.]+$", "")


def with_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """Texts joined to their JSON by stem; unpaired files leave."""
    texts = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(_stem("_metadata.file_path").alias("stem"), F.col("value").alias("text"))
    meta = spark.read.schema(SIDECAR).option("pathGlobFilter", "*.json").json(folder, multiLine=True).withColumn("stem", _stem("_metadata.file_path"))
    return texts.join(meta, "stem").withColumn("id", F.coalesce("id", "stem"))


def pdf_pages(files: DataFrame, reader: Callable[[bytes], list[str]] | None) -> DataFrame:
    """(path, text, page_count) by a plugged-in reader of page texts; without one the rows carry nulls."""
    schema = "path string, text string, page_count int"

    def read(batches):
        for pdf in batches:
            rows = []
            for p, c in zip(pdf["path"], pdf["content"]):
                pages = reader(bytes(c)) if reader else None
                rows.append((p, None if pages is None else "\n\n".join(pages), None if pages is None else len(pages)))
            yield pd.DataFrame(rows, columns=["path", "text", "page_count"])

    return files.select("path", "content").mapInPandas(read, schema)


def ocr_pages(files: DataFrame, recognise: Callable[[bytes], list[list[str]]]) -> DataFrame:
    """(path, text): lines of a page joined by blanks, pages by blank lines. The engine is plugged in; rows should be filtered first."""

    def read(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "text": ["\n\n".join(" ".join(lines) for lines in recognise(bytes(c))) for c in pdf["content"]]})

    return files.select("path", "content").mapInPandas(read, "path string, text string")


def append_errors(errors: DataFrame, path: str) -> None:
    cols = [c.split()[0] for c in ERROR.split(", ")]
    errors.select(*cols).write.mode("append").json(path)


def write_chunks(chunks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One dataset partitioned by profile, not one file per document."""
    chunks.write.mode(mode).option("compression", "zstd").partitionBy("profile").parquet(path)


def read_manifest(spark: SparkSession, path: str, schema: str = "status string, title string, author string, tradition string, source_url string, file_type string, chapters int, download_date timestamp, failed_date timestamp, error string") -> DataFrame:
    """(item_id, ..) of a JSON manifest; a missing file is an empty manifest."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.schema(f"items map<string, struct<{schema.replace(' ', ': ').replace(',: ', ', ')}>>").json(path, multiLine=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "item_id string, " + schema)
    return df.select(F.explode("items").alias("item_id", "_a")).select("item_id", "_a.*")
