"""Text scalars as column expressions: cleaning, gates, scores and hashes. All of them stay in the JVM but ``nfkc``.

Python's notions are kept: *strip* removes all Unicode white space, *splitlines* breaks at every line separator, lengths are
code points.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SPACE = r"[\s\x1c-\x1f]"
_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

#: The words whose presence marks a text as Latin.
LATIN_WORDS = (
    "et", "est", "in", "non", "sed", "ad", "per", "cum", "vel", "enim", "autem", "quod", "qui", "quae", "quam", "quis", "omnis", "omnia",
    "esse", "sunt", "erat", "ille", "illa", "illud", "hoc", "haec", "deus", "dei", "terra", "caelum", "vitae", "anima", "spiritus",
)

#: Title fragments that mark a record as off topic.
OFF_TOPIC_TITLES = (
    "global positioning system", "gps pseudolites", "zero taxes", "chiesa viva", "secrets of nasa", "secrets of nassa", "chernobyl",
    "nuclear disaster hoax", "americanisation of the world", "ringmakers of saturn", "new testament in indonesian", "new testament in urdu",
    "alkitab", "perjanjian baru", "hindustani", "denis fahey collection", "016 cd r&", "synarchy movement of empire",
    "australian personal computer", "ijelfeb", "ijasrjun",
)

#: Fixed value: characters counted as unusual, beside all outside of ASCII.
WEIRD_CLASS = r"[^\x00-\x7f]|[|{}\[\]<>\\^~`]"


#: The white space of ``_SPACE``, one by one, for trimming from the ends without a search through the text.
_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def split_lines(c: Column) -> Column:
    """Lines of a text; a final line break opens no further line. The text is referred to once, as nested expressions would
    otherwise evaluate it over and over."""
    return F.split(F.regexp_replace(c, rf"(?:{_LINE_BREAK})\z", ""), _LINE_BREAK, -1)


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """Unicode NFKC, which Spark lacks; ASCII texts pass through untouched."""
    return _nfkc(c)


def rejoin_hyphenated(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)(\w)-\s*\n\s*(\w)", "$1$2")


def drop_noise_lines(c: Column, preserve_paragraphs: bool = False) -> Column:
    """Lines of at most two characters leave, unless they are two ASCII letters or digits, or a roman numeral.

    Blank lines are such lines too; ``preserve_paragraphs`` keeps them."""

    def keep(line: Column) -> Column:
        s = strip(line)
        kept = (F.length(s) > 2) | s.rlike(r"^[A-Za-z0-9]{2}$") | s.rlike(r"^[IVXLCDM]+$")
        return kept | (F.length(s) == 0) if preserve_paragraphs else kept

    return F.array_join(F.filter(split_lines(c), keep), "\n")


def drop_page_numbers(c: Column) -> Column:
    """A line of one to four digits becomes a blank line; of two such lines in a row the second stays, as its break is used up."""
    return F.regexp_replace(c, r"(?U)\n\s*\d{1,4}\s*\n", "\n\n")


def tidy_lines(c: Column) -> Column:
    return F.array_join(F.transform(split_lines(c), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " "))), "\n")


def collapse_blank_lines(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def normalize_text(c: Column, preserve_paragraphs: bool = False, fold: bool = True) -> Column:
    """Fold, rejoin, drop noise lines, drop page numbers, tidy and collapse, in this order."""
    steps = [rejoin_hyphenated, lambda x: drop_noise_lines(x, preserve_paragraphs), drop_page_numbers, tidy_lines, collapse_blank_lines]
    return reduce(lambda x, f: f(x), steps, nfkc(c) if fold else c)


def latin_hits(c: Column) -> Column:
    """How many different words of the Latin list a text holds."""
    words = F.transform(F.split(F.lower(c), rf"(?U){_SPACE}+"), lambda w: F.regexp_replace(w, r"^[.,;:!?\"'()]+|[.,;:!?\"'()]+$", ""))
    return F.size(F.array_distinct(F.filter(words, lambda w: w.isin(*LATIN_WORDS))))


def is_latin(c: Column) -> Column:
    return latin_hits(c) >= 3


def detect_language(c: Column, detector=None, default: str = "en", first: int = 1000) -> Column:
    """``la`` by the word list, else what ``detector`` (Column -> Column) says of the first characters, else ``default``.

    The length is that of the rule itself: a language is told from the beginning of a text."""
    head = F.left(c, F.lit(first))
    other = detector(head) if detector else F.lit(default)
    return F.when(is_latin(head), "la").otherwise(F.coalesce(other, F.lit(default)))


#: Frequent words by which the plain detector tells a language.
FREQUENT_WORDS = {
    "en": ("the", "and", "of", "to", "that", "is", "was", "with", "which", "this"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "wenn", "sich", "mit"),
    "fr": ("le", "la", "les", "et", "est", "que", "dans", "pas", "une", "qui"),
    "it": ("il", "di", "che", "non", "per", "della", "una", "sono", "nella", "gli"),
    "es": ("el", "los", "las", "que", "una", "por", "con", "para", "del", "pero"),
}


def _one_of(words: tuple[str, ...]):
    return lambda w: w.isin(*words)


def word_vote(words: dict[str, tuple[str, ...]] = FREQUENT_WORDS, least: int = 3):
    """A detector for ``detect_language``: the language most of whose words occur (every occurrence counts), the first of equals; null below
    ``least``. It stays in the JVM; a model can be given in its place, as a function from a column to a column."""

    def detect(c: Column) -> Column:
        found = F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+"), F.lit(0))
        hits = [F.struct(F.size(F.filter(found, _one_of(v))).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, (k, v) in enumerate(words.items())]
        best = F.array_max(F.array(*hits))
        return F.when(best["n"] >= least, best["k"])

    return detect


def normalize_title(c: Column) -> Column:
    return F.regexp_replace(strip(F.lower(c)), rf"(?U){_SPACE}+", " ")


def weird_ratio(c: Column, first: int = 2000) -> Column:
    """Share of unusual characters in the leading ``first`` characters; 0 for an empty text."""
    s = F.left(c, F.lit(first))
    n = F.length(s).cast("double")
    return F.when(n > 0, (n - F.length(F.regexp_replace(s, WEIRD_CLASS, ""))) / n).otherwise(F.lit(0.0))


def is_sparse(c: Column, first: int = 2000) -> Column:
    """Ten or more lines with text, more than half of them of at most three characters."""
    lines = F.filter(F.transform(split_lines(F.left(c, F.lit(first))), strip), lambda x: F.length(x) > 0)
    short = F.size(F.filter(lines, lambda x: F.length(x) <= 3))
    return (F.size(lines) >= 10) & (short * 2 > F.size(lines))


def is_garbled(c: Column, max_ratio: float = 0.10) -> Column:
    return F.coalesce((F.length(c) == 0) | (weird_ratio(c) > max_ratio) | is_sparse(c), F.lit(True))


def is_off_topic(title: Column, fragments: tuple[str, ...] = OFF_TOPIC_TITLES) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in fragments])


def coerce_string(c: Column, default: str = "", is_array: bool = False) -> Column:
    return F.coalesce(F.array_join(c, "; ") if is_array else c.cast("string"), F.lit(default))


def quality_score(c: Column, first: int = 5000) -> Column:
    """Stripped length x share of usual characters x mean word length over 5 (1 at most); 0 for a blank text."""
    s = F.left(c, F.lit(first))
    words = F.filter(F.split(s, rf"(?U){_SPACE}+"), lambda w: w != "")
    letters = F.length(F.array_join(words, "")).cast("double")
    mean = letters / F.greatest(F.size(words), F.lit(1))
    n = F.length(strip(c)).cast("double")
    return F.when(n > 0, n * (F.lit(1.0) - weird_ratio(c, first)) * F.least(mean / 5.0, F.lit(1.0))).otherwise(F.lit(0.0))


def content_hash(c: Column, prefix: int = 2000, lowercase: bool = True) -> Column:
    """SHA-256 of the leading characters of the stripped text; cut first, then lower-cased."""
    s = F.left(strip(c), F.lit(prefix))
    return F.sha2(F.lower(s) if lowercase else s, 256)


def preview(c: Column, n: int = 200) -> Column:
    return F.translate(F.left(c, F.lit(n)), "\n", " ")


def whitespace_tokens(c: Column) -> Column:
    """The default tokenizer: runs without white space; an empty text has none."""
    return F.filter(F.split(strip(c), rf"(?U){_SPACE}+"), lambda w: w != "")
