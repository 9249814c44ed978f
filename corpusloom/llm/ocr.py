"""Problem 2: damage of scanned pages: running headers, page numbers, words cut at line ends, misrecognised words.

A vocabulary with document frequencies is counted over the records that show no trace of a page layout. Every word outside
of it is looked up by intersecting its Levenshtein automaton with the vocabulary's trie, which retrieves all words within
the distance; candidates are ranked by the shapes that scanners confuse, by frequency and by the word before. Capitalised and known
but rare words go through the automaton of weighted edits, in which a confusion of shapes costs least. Invented names, which no
vocabulary holds, are the words of a second automaton, that of usual letter trigrams, and are retrieved from it in the same way. Then page furniture is removed and lines are
flowed into paragraphs.

Sizes: a word enters the vocabulary if a share ``rate`` of the clean records hold it, so it has at most (words a record) /
rate words however large the corpus is; word pairs likewise; trigrams are bounded by the alphabet. These are what is sent to
the workers.

Defined cases: null and blank texts give no row; ids count once; records that are not prose are left out; a text without
damage gives no row in ``damaged_lines`` and comes out of ``repair`` with its lines flowed; an empty table gives an empty
result; titles may be null or wrong (headers are then found by their place and repetition); extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import JAVA_WORD, distinct_texts, materialise, spread
from corpusloom.llm.quality import text_quality

#: Fixed values: (true, read) shapes that scanners confuse.
CONFUSIONS = (
    ("h", "b"), ("e", "c"), ("c", "e"), ("t", "f"), ("f", "t"), ("m", "rn"), ("rn", "m"), ("n", "ri"), ("u", "ii"), ("h", "li"), ("li", "h"), ("d", "cl"), ("cl", "d"),
    ("g", "q"), ("l", "1"), ("i", "1"), ("l", "|"), ("i", "|"), ("o", "0"), ("s", "5"), ("i", "!"), ("a", "@"), ("s", "ſ"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("t", "'i'"), ("b", "6"), ("g", "9"), ("z", "2"), ("l", "i"), ("i", "l"),
    ("n", "u"), ("u", "n"), ("w", "vv"), ("vv", "w"), ("nn", "m"), ("in", "m"), ("m", "in"), ("ri", "n"), ("ii", "u"), ("a", "o"), ("o", "a"), ("v", "y"), ("y", "v"), ("e", "o"), ("o", "e"), ("l", "t"), ("t", "l"), ("B", "8"), ("E", "F"), ("S", "5"), ("O", "0"), ("I", "l"), ("I", "1"),
)
NOISE = "¬|\\~^{}<>@*_=+#$%&§°•`¦\xad"
HYPHENS = "-‐¬\xad‑–"
#: A line that holds only a page's number.
PAGE = re.compile(r"^\s*(?:(?:page|p\.|pag\.|pg\.|seite|s\.)\s*)?[\[({*.~|—–-]*\s*(?:\d{1,4}|[ivxlcdm]{1,8})\s*[\])}*.~|—–-]*\s*$|^\s*(?:Page|PAGE|P\.)\s*[\dIVXLCDMlOo]{1,8}[.\])]*\s*$")
CHAPTER = re.compile(r"^\s*(?:chapter|section|part|kapitel|chapitre|capitolo|cap[ií]tulo|caput)\s+[\divxlcdm]+\b", re.I)
PART = re.compile(r"^\s*(?:\d{1,4}\s+)?(?:book|part|volume|buch|teil|livre|partie|libro|parte|liber|pars)\s+[ivxlcdm1|!]+\s*[.,:]\s*\S")
#: Shapes that hold no letters stand for one: a line is compared with a title after they are read as letters.
_SHAPES = {read: true for true, read in reversed(CONFUSIONS) if not read.isalpha()}
_SHAPE = re.compile("|".join(re.escape(x) for x in sorted(_SHAPES, key=len, reverse=True)))


def as_letters(line: str) -> str:
    """The line in lower case, numbers inside of words and marks read as the letters they resemble."""
    return re.sub(r"\S*[^\W\d_]\S*", lambda m: _SHAPE.sub(lambda x: _SHAPES[x.group()], m.group()), line).lower()


#: A row of a table inside a text: its cells are no words.
ROW = re.compile(r";[^;\s]+;|\s\|\s.*\s\|\s|\t\S*\t|\S {3,}\S+ {3,}\S|^\s*[-|+:]{3,}\s*$")
_EDGE_L, _EDGE_R = "\"'“‘(¿¡[«*", ".,;:!?\"'”’)]»*"


class Trie:
    """Prefix tree of a vocabulary: node = (children by letter, frequency of the word that ends here or 0)."""

    def __init__(self, words: dict[str, int]) -> None:
        self.root: list = [{}, 0]
        for w, n in words.items():
            node = self.root
            for ch in w:
                node = node[0].setdefault(ch, [{}, 0])
            node[1] = n
        self.start = self.root

    @staticmethod
    def follow(node: list, prefix: str):
        return node[0].items()

    @staticmethod
    def ends(node: list, prefix: str) -> int:
        return node[1]


class LevenshteinAutomaton:
    """Deterministic view of the automaton that accepts all words within ``k`` edits of ``word``.

    A state is the row of least edits after each prefix of the word, cut at k + 1; transitions are kept as they are met."""

    def __init__(self, word: str, k: int) -> None:
        self.word, self.k = word, k
        self.start = tuple(min(i, k + 1) for i in range(len(word) + 1))
        self.moves: dict[tuple, tuple] = {}

    def step(self, state: tuple, ch: str) -> tuple | None:
        key = (state, ch if ch in self.word else "")
        if key not in self.moves:
            top, row = self.k + 1, [min(state[0] + 1, self.k + 1)]
            for i, c in enumerate(self.word):
                row.append(min(state[i] + (c != ch), row[i] + 1, state[i + 1] + 1, top))
            self.moves[key] = tuple(row) if min(row) <= self.k else None
        return self.moves[key]

    def within(self, trie: Trie) -> list[tuple[str, int, int]]:
        """(word, edits, frequency) of every word of the trie that the automaton accepts."""
        out, stack = [], [(trie.root, self.start, "")]
        while stack:
            node, state, prefix = stack.pop()
            if node[1] and state[-1] <= self.k:
                out.append((prefix, state[-1], node[1]))
            for ch, child in node[0].items():
                nxt = self.step(state, ch)
                if nxt is not None:
                    stack.append((child, nxt, prefix + ch))
        return out


def reading_cost(true: str, read: str) -> float:
    """Least cost of misreading ``true`` as ``read``: 1 for a confusion or a stray mark, 1.6 for any other edit."""
    n, m = len(true), len(read)
    best = [[math.inf] * (m + 1) for _ in range(n + 1)]
    best[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            c = best[i][j]
            if c == math.inf:
                continue
            if i < n and j < m:
                best[i + 1][j + 1] = min(best[i + 1][j + 1], c + (0 if true[i] == read[j] else 1.6))
            if i < n:
                best[i + 1][j] = min(best[i + 1][j], c + 1.6)
            if j < m:
                best[i][j + 1] = min(best[i][j + 1], c + (1 if read[j] in NOISE else 1.6))
            for a, b in CONFUSIONS:
                if true.startswith(a, i) and read.startswith(b, j):
                    x, y = i + len(a), j + len(b)
                    best[x][y] = min(best[x][y], c + 1)
    return best[n][m]


class ReadingAutomaton:
    """The Levenshtein automaton of weighted edits: accepts what ``word`` may be a misreading of at a ``reading_cost`` of at most ``limit``.

    A state is the rows of least costs after the last prefixes (as many as the longest shape has letters), cut at the limit; it runs
    over any lexicon that gives the letters that may follow."""

    def __init__(self, word: str, limit: float) -> None:
        self.word, self.limit = word, limit + 1e-9
        row = [0.0]
        for ch in word:
            row.append(row[-1] + (1 if ch in NOISE else 1.6))
        self.start = (row,)
        self.shapes: dict[str, list[tuple[str, int, list[int]]]] = {}
        for true, read in CONFUSIONS:
            ends = [j + len(read) for j in range(len(word) - len(read) + 1) if word.startswith(read, j)]
            if ends:
                self.shapes.setdefault(true[-1], []).append((true, len(read), ends))

    def step(self, state: tuple, prefix: str, ch: str) -> tuple | None:
        """The state after ``prefix + ch``; None if nothing within the limit can follow."""
        word, last, text = self.word, state[-1], prefix + ch
        row = [last[0] + 1.6]
        for j, c in enumerate(word):
            row.append(min(last[j] + (0 if c == ch else 1.6), last[j + 1] + 1.6))
        for true, size, ends in self.shapes.get(ch, ()):
            if len(true) <= len(state) and text.endswith(true):
                before = state[-len(true)]
                for j in ends:
                    row[j] = min(row[j], before[j - size] + 1)
        for j, c in enumerate(word):
            row[j + 1] = min(row[j + 1], row[j] + (1 if c in NOISE else 1.6))
        if min(row) > self.limit and min(last) > self.limit:
            return None
        return (*state[-1:], row)

    def within(self, lexicon: "Trie | NameGraph") -> list[tuple[float, str, int]]:
        """(cost, word, frequency) of every word of the lexicon that the automaton accepts."""
        out, stack = [], [(lexicon.start, self.start, "")]
        while stack:
            node, state, prefix = stack.pop()
            n = lexicon.ends(node, prefix)
            if n and prefix and state[-1][-1] <= self.limit:
                out.append((state[-1][-1], prefix, n))
            for ch, child in lexicon.follow(node, prefix):
                nxt = self.step(state, prefix, ch)
                if nxt is not None:
                    stack.append((child, nxt, prefix + ch))
        return out


class NameGraph:
    """The names whose letter trigrams are all usual, as an automaton: a state is the last two letters."""

    def __init__(self, grams: dict[str, int], least: float) -> None:
        self.next: dict[str, list[tuple[str, str]]] = {}
        self.last: set[str] = set()
        for g, n in grams.items():
            if n >= least and len(g) == 3:
                if g[2] == "$":
                    self.last.add(g[:2])
                else:
                    self.next.setdefault(g[:2], []).append((g[2], g[1:]))
                if g[0] == "^":
                    self.next.setdefault("^", []).append((g[1], g[:2]))
        self.next["^"] = sorted(set(self.next.get("^", ())))
        self.start = "^"

    def follow(self, node: str, prefix: str) -> list[tuple[str, str]]:
        return self.next.get(node, [])

    def ends(self, node: str, prefix: str) -> int:
        return int(len(prefix) >= 3 and node in self.last)


def trigrams(name: str) -> list[str]:
    s = f"^{name.lower()}$"
    return [s[i : i + 3] for i in range(len(s) - 2)]


class Lexicon:
    """What a worker knows of the language of the corpus."""

    def __init__(self, words: dict[str, int], pairs: dict[tuple[str, str], int], compounds: set[str], grams: dict[str, int], names: int) -> None:
        self.words, self.pairs, self.compounds, self.grams = words, pairs, compounds, grams
        self.least_gram = max(2.0, names * 4e-5)
        self.common = max(words.values(), default=1)
        self.trie: Trie | None = None
        self.names: NameGraph | None = None
        self.seen: dict[str, str | None] = {}

    def __getstate__(self):
        return (self.words, self.pairs, self.compounds, self.grams, self.least_gram, self.common)

    def __setstate__(self, s):
        self.words, self.pairs, self.compounds, self.grams, self.least_gram, self.common = s
        self.trie, self.names, self.seen = None, None, {}

    def _build(self) -> None:
        if self.trie is None:
            self.trie, self.names = Trie(self.words), NameGraph(self.grams, self.least_gram)

    def candidates(self, word: str, k: int) -> list[tuple[str, int, int]]:
        self._build()
        return LevenshteinAutomaton(word, k).within(self.trie)

    def readings(self, word: str, limit: float) -> list[tuple[float, str, int]]:
        """(cost, word, frequency) of the words of the vocabulary that may have been read as ``word``."""
        self._build()
        return ReadingAutomaton(word, limit).within(self.trie)

    def name_readings(self, word: str) -> list[str]:
        """Names that may have been read as ``word`` by one confusion or stray mark, else by two; the cheapest first."""
        self._build()
        for limit in (1, 2):
            found = sorted((c, w) for c, w, _ in ReadingAutomaton(word, limit).within(self.names) if w != word)
            if found:
                return [w for _, w in found]
        return []

    def is_name(self, w: str) -> bool:
        return len(w) >= 3 and all(self.grams.get(g, 0) >= self.least_gram for g in trigrams(w))

    def correct(self, core: str, before: str = "") -> str | None:
        """The word that was misread as ``core``, or None if it is read right or can't be told."""
        low = core.lower()
        n = self.words.get(low, 0)
        if n and n * 60 >= self.common:
            return None
        if core not in self.seen:
            if len(self.seen) > 400_000:
                self.seen.clear()
            self.seen[core] = self._lookup(core, low, n)
        found = self.seen[core]
        if found is None or len(found) < 2:
            return found[0] if found else None
        # context: among readings of like cost the one seen after the word before
        return max(found, key=lambda w: self.pairs.get((before, w.lower()), 0))

    def _lookup(self, core: str, low: str, n: int) -> list[str] | None:
        letters = sum(ch.isalpha() for ch in core)
        if not letters:
            return ["a"] if core == "@" and "a" in self.words else None
        marked = any(ch in NOISE or ch.isdigit() or ch in "!ſ" for ch in core.rstrip("!"))
        capital = core[0].isupper() or (marked and not core[0].isalpha())
        if n:  # a known but rare word: only if it is a confusion of a far more frequent one
            if core[0].isupper() and self.is_name(low):
                return None
            found = sorted((c, -f, w) for c, w, f in self.readings(low, 1) if w != low and f >= 300 * n)
            return [w for *_, w in found] or None
        if capital and not marked:
            if self.is_name(low):
                return None
            direct = sorted((c, -f, w) for c, w, f in self.readings(low, 1))
            return [w.capitalize() for w in [w for *_, w in direct] or self.name_readings(low)] or None
        plain = low.translate({ord(ch): None for ch in NOISE})
        if plain != low and (plain in self.words or self.is_name(plain)):
            return [plain]
        found = self.candidates(low, 1) if len(low) <= 4 else []
        if not found:
            found = self.candidates(low, 2)
            if len(low) <= 4:  # in short words two edits must be one confusion
                found = [x for x in found if reading_cost(x[0], low) <= 1]
        if not found and marked and len(low) > 3:
            found = self.candidates(plain, 1 if len(plain) <= 4 else 2)
        ranked = sorted((reading_cost(w, low) - 0.08 * math.log1p(f), w) for w, _, f in found if len(w) > 1 or marked)
        ranked = [(c, w) for c, w in ranked if c <= ranked[0][0] + 0.4 and c <= 2.6]
        if ranked:
            return [w for _, w in ranked]
        if marked:
            return ([plain] if self.is_name(plain) else []) + self.name_readings(low) or ([plain] if letters >= 2 else None)
        return None


def lexicon(texts: DataFrame, key: str = "id", rate: float = 1 / 4000, pair_rate: float = 1 / 800) -> Lexicon:
    """Counts over the records without traces of a page layout; ``texts`` holds (key, text)."""
    dirty = r"\p{L}[-‐¬­]\s*\n|\p{L}[|¬\\~^@0-9!]+\p{L}|(?m)^\s*(?:(?:[Pp]age|p\.) *)?[\[(*.~ -]*\d{1,4}[\]) *.~-]*$|(?m)^\s*[ivxlc]+\s*$"
    clean = texts.where(~F.col("text").rlike(dirty)).select("text")
    split = clean.select(F.regexp_extract_all(F.lower("text"), F.lit(JAVA_WORD), F.lit(0)).alias("w"), F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+-\p{L}+"), F.lit(0)).alias("c"), F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<=[\p{Ll},;] )\p{Lu}\p{Ll}{2,}"), F.lit(0))).alias("names"))
    two = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    marked = F.transform("names", lambda x: F.concat(F.lit("^"), F.lower(x), F.lit("$")))
    grams = F.flatten(F.transform(marked, lambda x: F.transform(F.sequence(F.lit(1), F.length(x) - 2), lambda i: F.substring(x, i, F.lit(3)))))
    kinds = {"t": F.array(F.lit("")), "w": F.array_distinct("w"), "c": F.array_distinct("c"), "p": F.array_distinct(two), "g": grams, "n": F.transform("names", lambda x: F.lit(""))}
    # one pass over the texts counts records, words, compounds, pairs, trigrams and names
    named = lambda k, a: F.transform(a, lambda x: F.struct(F.lit(k).alias("kind"), x.alias("x")))
    tokens = F.flatten(F.array(*[named(k, a) for k, a in kinds.items()]))
    counted = materialise(split.select(F.explode(tokens).alias("e")).groupBy("e.kind", "e.x").agg(F.count("*").alias("n")).where("n >= 2 or kind in ('t', 'n')"))
    whole = {r["kind"]: r["n"] for r in counted.where("kind in ('t', 'n')").collect()}
    total = whole.get("t", 0)
    least = {"w": max(2, math.ceil(total * rate)), "c": max(2, math.ceil(total * rate)), "p": max(3, math.ceil(total * pair_rate)), "g": 2}
    enough = F.coalesce(*[F.when(F.col("kind") == k, F.col("n") >= n) for k, n in least.items()], F.lit(False))
    found: dict[str, dict[str, int]] = {k: {} for k in least}
    for k, x, n in counted.where(enough).select("kind", "x", "n").toPandas().itertuples(index=False):
        found[k][x] = int(n)
    pairs = {tuple(x.split(" ")): n for x, n in found["p"].items() if x.count(" ") == 1}
    return Lexicon(found["w"], pairs, set(found["c"]), found["g"], whole.get("n", 0))


def _normal(line: str) -> str:
    s = as_letters(re.sub(r"^\s*\d{1,4}\s+|\s+\d{1,4}\s*$", "", line.strip()))
    m = PART.match(s)
    s = s[m.end() - 1 :] if m else s
    return re.sub(r"[^a-z ]", "", s).strip()


@lru_cache(maxsize=4096)
def _near(a: str, b: str) -> bool:
    """Is ``a`` within a fifth of its length of a prefix of ``b``?"""
    if len(a) < 5 or len(a) > len(b) * 1.3 + 3:
        return False
    row = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, cb in enumerate(b, 1):
            prev, row[j] = row[j], min(prev + (ca != cb), row[j] + 1, row[j - 1] + 1)
    return min(row) <= max(1, len(a) // 5)


def furniture(lines: list[str], title: str | None) -> dict[int, str]:
    """Line index -> ``header`` or ``page_number``."""
    out: dict[int, str] = {}
    blank = [not x.strip() for x in lines]
    roman = [i for i, x in enumerate(lines) if re.fullmatch(r"\s*[IVXLCDM]+\.?\s*", x)]
    for i, x in enumerate(lines):
        if not blank[i] and PAGE.match(x) and i not in roman:
            out[i] = "page_number"
    t = _normal(title or "")
    shapes = {i: _normal(x) for i, x in enumerate(lines) if not blank[i] and i not in out and len(x) < 90}
    repeated = Counter(s for s in shapes.values() if len(s) >= 6)
    for i, s in shapes.items():
        x = lines[i].strip()
        if CHAPTER.match(x):
            continue
        if PART.match(as_letters(x)) and len(x) < 80 and (x.upper() == x or not x.endswith((".", ",", ";"))):
            out[i] = "header"
        elif t and len(s) >= 6 and not x.endswith((".", ";", "?")) and _near(s, t) and len(s) >= min(len(t) * 0.4, 18):
            out[i] = "header"
        elif len(s) >= 6 and not x.endswith((".", ",", ";", "?", *HYPHENS)) and (repeated[s] >= 2 or re.search(r"^\d{1,4}\s{3,}\S|\S\s{3,}\d{1,4}$", x)):
            near_page = any(j in out for j in (i - 1, i + 1, i - 2, i + 2)) or i == 0 or re.search(r"^\d{1,4}\s{3,}\S|\S\s{3,}\d{1,4}$", x)
            titled = sum(w[:1].isupper() for w in x.split() if w[:1].isalpha()) >= 0.5 * sum(w[:1].isalpha() for w in x.split())
            if near_page and titled and not ROW.search(x):
                out[i] = "header"
    return out


def _core(token: str) -> tuple[int, int]:
    a, b = 0, len(token)
    while a < b and token[a] in _EDGE_L:
        a += 1
    while b > a and token[b - 1] in _EDGE_R:
        b -= 1
    return a, b


def _parts(core: str) -> list[str]:
    return [p for p in re.split(r"(?<=\w)[-‐'’—–]+(?=\w)|--+", core) if p]


class Page:
    """Everything found in one text: furniture, cut words, misread words, and the repaired text."""

    def __init__(self, text: str, title: str | None, lex: Lexicon) -> None:
        self.lines = text.split("\n")
        self.furniture = furniture(self.lines, title)
        self.hyphen: set[int] = set()
        self.misread: set[int] = set()
        self.fixed: list[str] = []
        self._read(lex)

    def _read(self, lex: Lexicon) -> None:
        body = [i for i, x in enumerate(self.lines) if x.strip() and i not in self.furniture]
        tokens = {i: self.lines[i].split() for i in body}
        for at, i in enumerate(body):  # cut words
            x = self.lines[i].rstrip()
            if len(x) < 2 or x[-1] not in HYPHENS or not x[-2].isalpha() or at + 1 == len(body):
                continue
            nxt = tokens[body[at + 1]]
            head = re.sub(r"[^\w'’]+$", "", nxt[0]) if nxt else ""
            if not head or not (head[0].islower() or not head[0].isalpha()):
                continue
            left = tokens[i][-1].rstrip(HYPHENS).lstrip(_EDGE_L)
            tail = re.split(r"[-‐'’]", left)[-1]
            joined = (tail + re.split(r"[^\w]", head)[0]).lower()
            if x[-1] == "-" and f"{left}-{head}".lower() in lex.compounds and joined not in lex.words:
                continue
            self.hyphen.add(i)
            tokens[i][-1] = tokens[i][-1].rstrip(HYPHENS) + nxt[0]
            tokens[body[at + 1]] = nxt[1:]
        before = ""
        for i in body:
            if CHAPTER.match(self.lines[i]) or ROW.search(self.lines[i]):
                continue
            row, j = tokens[i], 0
            while j < len(row):
                a, b = _core(row[j])
                core = row[j][a:b]
                if core and j + 1 < len(row) and b == len(row[j]) and self._split(core, row[j + 1], lex):
                    row[j : j + 2] = [row[j] + row[j + 1]]
                    self.misread.add(i)
                    continue
                new = None
                for part in _parts(core):
                    fix = lex.correct(part, before)
                    if fix is None and part == core and row[j][b : b + 1] == "!" and part.lower() not in lex.words:
                        fix = lex.correct(part + "!", before) if not lex.is_name(part) else None
                        if fix is not None and fix.lower() not in lex.words:
                            fix = None
                    if fix is not None:
                        new = (new or core).replace(part, fix, 1)
                    before = (fix or part).lower()
                if new is None and core and any(ch in "|¬\\~^{}<>@" for ch in core) and any(ch.isalpha() for ch in core):
                    new = core
                if new is None and a > 0 and any(ch in NOISE for ch in row[j][:a].replace("*", "")):
                    new = core
                if new is not None:
                    row[j] = row[j][:a] + new + row[j][b:]
                    self.misread.add(i)
                j += 1
        self.tokens = tokens

    @staticmethod
    def _split(core: str, follower: str, lex: Lexicon) -> bool:
        """A word read as two."""
        _, e = _core(follower)
        rest = follower[:e]
        if not rest or not rest[0].islower() or not rest.isalpha() or not core.isalpha():
            return False
        left, right, both = core.lower(), rest.lower(), (core + rest).lower()
        if left in lex.words and right in lex.words:
            return False
        if both in lex.words:
            return True
        return core[0].isupper() and right not in lex.words and lex.is_name(both) and not lex.is_name(left) and len(core) >= 2

    def kinds(self) -> list[tuple[int, str]]:
        out = [(i + 1, k) for i, k in self.furniture.items()]
        return sorted(out + [(i + 1, "hyphen") for i in self.hyphen] + [(i + 1, "misread") for i in self.misread])

    def repaired(self) -> str:
        paragraphs, now = [], []
        for i, x in enumerate(self.lines):
            if i in self.furniture:
                continue
            if not x.strip():
                # a blank line inside a sentence was left by a page break
                if now and (now[-1][-1:] in ".!?\"'”’:" or CHAPTER.match(self.lines[i - 1] if i else "")):
                    paragraphs.append(" ".join(now))
                    now = []
                continue
            if now and (x[:2] == "  " and now[-1][-1:] in ".!?\"'”’" or CHAPTER.match(x)):
                paragraphs.append(" ".join(now))
                now = []
            if self.tokens.get(i):
                now.append(" ".join(self.tokens[i]))
        if now:
            paragraphs.append(" ".join(now))
        return "\n\n".join(paragraphs)


def _prose(records: DataFrame, key: str) -> DataFrame:
    keep = text_quality(records, key).where(F.col("kind") == "prose").select(key)
    return spread(distinct_texts(records, key, "text", "title"), key).join(keep, key, "left_semi")


def damaged_lines(records: DataFrame, key: str = "id") -> DataFrame:
    """(key, line_no, kind) of the damaged lines of prose records; kind is header, page_number, hyphen or misread."""
    texts = _prose(records, key)
    lex = lexicon(texts.select(key, "text"), key)
    shared = records.sparkSession.sparkContext.broadcast(lex)

    def find(batches):
        for pdf in batches:
            rows = [(k, n, kind) for k, text, title in zip(pdf[key], pdf["text"], pdf["title"]) for n, kind in Page(text, title, shared.value).kinds()]
            yield pd.DataFrame(rows, columns=[key, "line_no", "kind"])

    kind = records.schema[key].dataType.simpleString()
    return texts.mapInPandas(find, f"`{key}` {kind}, line_no int, kind string")


def repair(records: DataFrame, key: str = "id") -> DataFrame:
    """(key, text, removed_lines, joined_words, corrected_lines): the text as continuous paragraphs."""
    texts = _prose(records, key)
    lex = lexicon(texts.select(key, "text"), key)
    shared = records.sparkSession.sparkContext.broadcast(lex)

    def mend(batches):
        for pdf in batches:
            rows = []
            for k, text, title in zip(pdf[key], pdf["text"], pdf["title"]):
                p = Page(text, title, shared.value)
                rows.append((k, p.repaired(), len(p.furniture), len(p.hyphen), len(p.misread)))
            yield pd.DataFrame(rows, columns=[key, "text", "removed_lines", "joined_words", "corrected_lines"])

    kind = records.schema[key].dataType.simpleString()
    return texts.mapInPandas(mend, f"`{key}` {kind}, text string, removed_lines int, joined_words int, corrected_lines int")
