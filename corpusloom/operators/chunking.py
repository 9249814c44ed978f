"""Chapters and overlapping token windows, as array expressions."""

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from corpusloom.functions.text import strip, whitespace_tokens

#: Fixed value: what a chapter heading begins with.
_HEAD = r"(?:Chapter|CHAPTER|Section|SECTION)\s+[\dIVXLCDM]+"
_SPLIT = rf"\n(?={_HEAD}[.:]\s*\S)"


@dataclass(frozen=True)
class Profile:
    name: str
    size: int
    overlap: int


#: Window sizes of the two uses of chunks.
SEARCH, CLUSTER = Profile("search", 512, 64), Profile("cluster", 2048, 128)


def chapters(text: Column) -> Column:
    """array<struct<title, text>>: parts at line breaks before a heading; the first line of a part that is a heading is its title.

    A text without a break is one chapter without title, its heading, if any, staying in the text. Blank parts leave."""
    parts = F.filter(F.transform(F.split(text, _SPLIT), strip), lambda p: p != "")

    def chapter(p: Column) -> Column:
        first = strip(F.substring_index(p, "\n", 1))
        head = first.rlike(rf"^{_HEAD}")
        body = strip(F.substring(p, F.length(first) + 1, F.length(p)))
        return F.struct(F.when(head, first).otherwise(F.lit("")).alias("title"), F.when(head, body).otherwise(p).alias("text"))

    whole = F.array(F.struct(F.lit("").alias("title"), strip(text).alias("text")))
    several = F.transform(parts, chapter)
    return F.when((F.size(F.split(text, _SPLIT)) <= 1) | (F.size(parts) == 0), whole).otherwise(several)


def windows(n: Column, size: int, overlap: int) -> Column:
    """array<struct<start, end>> of the windows over n tokens; one even for n = 0."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the window size")
    step = size - overlap
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / F.lit(float(step))).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct((i * step).alias("start"), F.least(i * step + size, n).alias("end")))


def chapter_rows(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per chapter with text: all columns but the text, ``chapter_no``, ``chapter``, ``text``."""
    rest = [c for c in df.columns if c not in (text, "chapters")]
    rows = df.where(F.col(text).isNotNull()).select(*rest, F.posexplode(chapters(F.col(text))).alias("chapter_no", "_c"))
    return rows.select(*rest, "chapter_no", F.col("_c.title").alias("chapter"), F.col("_c.text").alias("text")).where(F.length(strip(F.col("text"))) > 0)


_TOKENIZERS: dict = {}


def model_tokenizer(path: str):
    """(encode, decode) column functions of a tokenizer file, which must be readable on the workers; each worker loads it once."""
    def load():
        if path not in _TOKENIZERS:
            from tokenizers import Tokenizer

            _TOKENIZERS[path] = Tokenizer.from_file(path)
            _TOKENIZERS[path].encode_special_tokens = True
        return _TOKENIZERS[path]

    @F.pandas_udf(ArrayType(IntegerType()))
    def encode(s: pd.Series) -> pd.Series:
        return pd.Series([e.ids for e in load().encode_batch(s.fillna("").tolist(), add_special_tokens=False)])

    @F.pandas_udf(StringType())
    def decode(s: pd.Series) -> pd.Series:
        return pd.Series(load().decode_batch([x.tolist() for x in s]))

    return encode, decode


def chunk(df: DataFrame, key: str, profile: Profile = SEARCH, text: str = "text", tokenize=whitespace_tokens, join: str = " ", decode=None) -> DataFrame:
    """Overlapping windows of every chapter with the document's columns, ``chunk_id`` = key _ number and the position in the chapter.

    Chunk numbers run through a document; they come from the chapter sizes, so no window over a document's chunks is sorted."""
    ch = chapter_rows(df, key, text).withColumn("_t", tokenize(F.col("text")))
    ch = ch.withColumn("_w", windows(F.size("_t"), profile.size, profile.overlap))
    before = Window.partitionBy(key).orderBy("chapter_no").rowsBetween(Window.unboundedPreceding, -1)
    # every row of a repeated key would count twice: keys are taken as unique
    ch = ch.withColumn("_b", F.coalesce(F.sum(F.size("_w")).over(before), F.lit(0)))
    rest = [c for c in ch.columns if c not in ("text", "_t", "_w", "_b", "chapter_no")]
    out = ch.select(*rest, "_t", "_b", F.posexplode("_w").alias("position_in_chapter", "_x"))
    number = F.lpad((F.col("_b") + F.col("position_in_chapter")).cast("string"), 5, "0")
    part = F.slice("_t", F.col("_x.start") + 1, F.greatest(F.col("_x.end") - F.col("_x.start"), F.lit(0)))
    body = decode(part) if decode else F.array_join(part, join)
    return out.select(*[c for c in rest if c != key], key, F.concat_ws("_", F.coalesce(F.col(key).cast("string"), F.lit("unknown")), number).alias("chunk_id"), "position_in_chapter", body.alias("text"), F.lit(profile.name).alias("profile"))


def truncate_tokens(tokens: Column, max_length: int) -> Column:
    """The leading tokens, two places being left for special ones."""
    return F.slice(tokens, 1, max(0, max_length - 2))
