import hashlib
import random
import re
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.titles import common_subsequence, fuzzy_title_links, indel_ratio, is_duplicate_title

ALPHABET = "aZé 1\t\n-‐|IVXß.,;§　0ﬁ"


def run(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").repartition(2)
    return [r["x"] for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def py_normalize(t, fold=True):
    t = unicodedata.normalize("NFKC", t) if fold else t
    t = re.sub(r"(\w)-\s*\n\s*(\w)", r"\1\2", t)
    kept = []
    for line in t.splitlines():
        s = line.strip()
        if len(s) > 2 or re.match(r"^[A-Za-z0-9]{2}$", s) or re.match(r"^[IVXLCDM]+$", s):
            kept.append(line)
    t = re.sub(r"\n\s*\d{1,4}\s*\n", "\n\n", "\n".join(kept))
    t = "\n".join(re.sub(r"[ \t]+", " ", x).strip() for x in t.splitlines())
    return re.sub(r"\n{3,}", "\n\n", t).strip()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=30, max_size=30))
def test_scalars_against_python(spark, values):
    assert run(spark, values, T.normalize_text) == [py_normalize(v) for v in values]
    assert run(spark, values, T.strip) == [v.strip() for v in values]
    assert run(spark, values, T.normalize_title) == [re.sub(r"\s+", " ", v.lower().strip()) for v in values]
    assert run(spark, values, T.content_hash) == [hashlib.sha256(v.strip()[:2000].lower().encode()).hexdigest() for v in values]
    weird = [sum(ord(c) > 127 or c in "|{}[]<>\\^~`" for c in v) / len(v) if v else 0.0 for v in values]
    assert all(abs(a - b) < 1e-12 for a, b in zip(run(spark, values, T.weird_ratio), weird))


def test_normalize_cases(spark):
    got = run(spark, ["ﬁre and dis-\ntinct", "one line here\n12\nanother line", "a\n7\nlong line", "first line\n1\n\nIV\nxx\n?", "x1 y\n11\n22\nlast line", None], T.normalize_text)
    assert got == ["fire and distinct", "one line here\n\nanother line", "long line", "first line\nIV\nxx", "x1 y\n\n22\nlast line", None]
    kept = run(spark, ["one line\n\nother line"], lambda c: T.normalize_text(c, preserve_paragraphs=True))
    assert kept == ["one line\n\nother line"]
    assert run(spark, ["é-\n x"], T.rejoin_hyphenated) == ["éx"]


def test_garbled(spark):
    prose = "A plain sentence about nothing in particular. " * 5
    sparse = "\n".join(["ab"] * 9 + ["a longer line of text"] * 3)
    assert run(spark, [prose, "", None, "§" * 20 + "a" * 80, sparse, "é" * 10 + "a" * 90], T.is_garbled) == [False, True, True, True, True, False]


def test_latin_and_language(spark):
    got = run(spark, ["In principio erat, et non est.", "The house and the road.", "Et, et! (et) est"], T.detect_language)
    assert got == ["la", "en", "en"]
    assert run(spark, ["Haus"], lambda c: T.detect_language(c, lambda h: F.lit("de"))) == ["de"]


def test_score_and_preview(spark):
    v = ["  \n", "abcde fghij", "ab cd"]
    assert run(spark, v, T.quality_score) == [0.0, 11.0, 2.0]
    assert run(spark, ["a\nb" + "x" * 300], T.preview) == [("a b" + "x" * 300)[:200]]


def py_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.text(alphabet="abcd ", max_size=20), st.text(alphabet="abcd ", max_size=20))
def test_common_subsequence(a, b):
    assert common_subsequence(a, b) == py_lcs(a, b)


def test_titles(spark):
    df = spark.createDataFrame([("The  Book of Fire ", "the book of fire"), ("Fire, the Book of", "The Book of Fire"), ("Rain", "Stone"), (None, "x")], "a string, b string")
    r = df.select(is_duplicate_title(F.col("a"), F.col("b")).alias("d"), indel_ratio("a", "b").alias("r")).collect()
    assert [x["d"] for x in r] == [True, False, False, None]


def test_fuzzy_links_are_complete(spark):
    import random

    rng = random.Random(5)
    base = ["the book of the mercury", "letters to a friend", "of the old road", "a treatise on salt"]
    titles = ["".join(c for c in t if rng.random() > 0.06) + rng.choice(["", "s", " ii"]) for t in base for _ in range(12)] + ["ab", "abc", "a", "", None, "the book of the mercury"]
    df = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    got = {r["id"]: r["links"] for r in fuzzy_title_links(df, "id").collect()}
    norm = [None if t is None else re.sub(r"\s+", " ", t.lower().strip()) for t in titles]
    for i, a in enumerate(norm):
        want = 0 if not a else sum(1 for j, b in enumerate(norm) if j != i and b and (2 * py_lcs(a, b) / (len(a) + len(b)) >= 0.85 or a == b))
        assert got[i] == want, (a, got[i], want)


@pytest.mark.parametrize("tile", [7, 1024])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh ", "\u00e9\u00dfab\U0001d538\u65e5\u672c\u8a9e x"])
def test_like_titles_against_all_pairs(monkeypatch, alphabet, tile):
    """Also of titles longer than one word of bits, beyond the counted steps and of letters that share a lot."""
    from corpusloom.functions import titles

    monkeypatch.setattr(titles, "_TILE", tile)
    rng = random.Random(len(alphabet))
    base = ["".join(rng.choices(alphabet, k=k)) for k in (1, 3, 30, 63, 64, 65, 130, 200)]
    x, y = ([("".join(c for c in rng.choice(base) if rng.random() > 0.05) + rng.choice(["", "s", "zz"])) or "q" for _ in range(40)] for _ in range(2))
    for t in (0.5, 0.85, 1.0):
        like = lambda a, b: 2.0 * common_subsequence(a, b) / (len(a) + len(b)) >= t  # noqa: B023, E731
        got = lambda *z: set(zip(*(v.tolist() for v in titles.like_titles(*z, threshold=t, at_once=50))))  # noqa: B023, E731
        assert got(x) == {(i, j) for j in range(40) for i in range(j) if like(x[i], x[j])}
        assert got(x, y) == {(i, j) for i in range(40) for j in range(40) if like(x[i], y[j])}


def test_title_links_of_few_patterns_in_time(spark):
    """Titles of one pattern share most of their letter pairs; a join by those had nearly every pair of titles many times over."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["cas", "bel", "mor", "dul", "zel", "fen", "hal", "ith", "vey", "rim"]) for _ in range(3))
    names = [word() for _ in range(120)]
    titles = [f"letters to {rng.choice(names)} concerning the {rng.choice(names)}" for _ in range(4000)]
    began = time.monotonic()
    got = {r["title"]: r["links"] for r in fuzzy_title_links(spark.createDataFrame(list(enumerate(titles)), "id int, title string"), "id").collect()}
    assert time.monotonic() - began < 60
    assert got.keys() == set(titles)
    for t in rng.sample(sorted(got), 20):
        assert got[t] == sum(2.0 * common_subsequence(t, u) / (len(t) + len(u)) >= 0.85 for u in titles) - 1


def test_title_links_of_odd_tables(spark):
    links = lambda titles: [r["links"] for r in fuzzy_title_links(spark.createDataFrame(list(enumerate(titles)), "id int, title string"), "id").orderBy("id").collect()]
    assert links([]) == [] and links([None, "", "  "]) == [0, 0, 0]
    assert links(["a", "x" * 3000, "A ", "x" * 2500 + "y", None, "x" * 900]) == [1, 1, 1, 1, 0, 0]
