"""Problem 10: subject areas of documents from weak votes whose accuracies are learned without truth.

Every paragraph is voted on by labelling functions: two lexicon readers (share of hits, hits per sentence), one that demands
several hits, one on the title (the address under which a text is filed), one on the neighbouring paragraphs (section) and
one on the tradition and one on the source. A latent model learns each function's accuracy and how often it abstains for each subject and
for *no subject*, by expectation-maximisation over the counts of vote patterns; patterns are few however many paragraphs there
are. A document has the subjects that, by the posterior probabilities of its paragraphs, are more likely than not the subject of at least a
``share`` of them; the probability is that of a sum of independent events, computed exactly.

The lexicon starts from a bounded sample of hand-labelled documents (``most_labels`` of least hash) and is then recounted over
all paragraphs whose words agree on a subject. A word enters if a share ``rate`` of the paragraphs hold it, so the lexicon
stays bounded however many there are.

Defined cases: null and blank texts give no row; keys are unique, repeated rows count once; labels given twice or against each
other all count; without labels nothing can be learned and no row results; null titles, traditions and sources abstain; an empty table
gives an empty result; ties abstain; extra columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import WORD, balanced, materialise, not_blank, slug
from corpusloom.llm.language import VOTES

_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_STOP = re.compile(r"[.!?]+[\"'”’)]*\s")
FUNCTIONS = ("words", "sentences", "several", "title", "section", "tradition", "source")


def paragraphs(text: str) -> list[str]:
    """The parts of a text between blank lines; a blank line may hold blanks."""
    return [p for p in _BLANK.split(text) if p.strip()]


class Votes:
    """The labelling functions; a vote is a subject's number or -1 to abstain, ``none`` means that no subject is there."""

    def __init__(self, lexicon: dict[str, tuple[int, float]], traditions: dict[str, int], n: int, sources: dict[str, int] | None = None) -> None:
        self.lexicon, self.traditions, self.n, self.sources = lexicon, traditions, n, sources or {}

    def hits(self, ws: list[str]) -> dict[int, float]:
        h: dict[int, float] = {}
        get = self.lexicon.get
        for w in ws:
            e = get(w)
            if e is not None:
                h[e[0]] = h.get(e[0], 0.0) + e[1]
        return h

    @staticmethod
    def _best(h: dict[int, float], least: float, lead: float) -> int:
        if not h:
            return -1
        k = min(h, key=lambda x: (-h[x], x))
        return k if h[k] >= least and h[k] >= lead * (sum(h.values()) - h[k]) else -1

    def document(self, text: str, title: str | None, tradition: str | None, source: str | None = None) -> list[tuple[int, ...]]:
        none = self.n
        low = text.lower()
        by_sentence = [[self.hits(WORD.findall(s)) for s in _STOP.split(p) if s.strip()] for p in paragraphs(low)]
        h: list[dict[int, float]] = []
        for parts in by_sentence:
            whole: dict[int, float] = {}
            for x in parts:
                for k, v in x.items():
                    whole[k] = whole.get(k, 0.0) + v
            h.append(whole)
        about = self._best(self.hits(WORD.findall(title.lower())), 0.5, 1.01) if title else -1
        school, origin = self.traditions.get(tradition or "", -1), self.sources.get(source or "", -1)
        first = [self._best(x, 0.8, 1.01) if sum(x.values()) >= 0.4 else none for x in h]
        out = []
        for i, parts in enumerate(by_sentence):
            named: dict[int, int] = {}
            for x in parts:
                t = self._best(x, 0.5, 1.01)
                if t >= 0:
                    named[t] = named.get(t, 0) + 1
            lead = min(named, key=lambda k: (-named[k], k)) if named else -1
            told = lead if named and named[lead] * 2 >= len(parts) else (none if sum(named.values()) * 4 <= len(parts) else -1)
            around = {first[j] for j in (i - 1, i + 1) if 0 <= j < len(first) and first[j] >= 0}
            section = around.pop() if len(around) == 1 else -1
            out.append((first[i], told, self._best(h[i], 2.4, 2.0), about, section, school, origin))
        return out


def fit_votes(patterns: np.ndarray, counts: np.ndarray, subjects: int, iterations: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of every pattern over subjects and *none*, accuracy of every function when it votes).

    The latent truth y has a prior; function j abstains with a probability that depends on whether y is a subject, is right
    with accuracy a_j (one for subjects, one for none), and errs evenly else."""
    k = subjects + 1
    p_, f_ = patterns.shape
    prior = np.full(k, 1 / k)
    acc = np.full((f_, 2), 0.0)
    acc[:] = np.array([0.9, 0.9, 0.95, 0.6, 0.6, 0.4, 0.4])[:f_, None]
    speak = np.full((f_, 2), 0.5)
    kind = np.array([0] * subjects + [1])
    post = np.zeros((p_, k))
    total = counts.sum()
    for _ in range(iterations):
        log = np.repeat(np.log(prior + 1e-9)[None], p_, 0)
        for j in range(f_):
            v = patterns[:, j]
            right = v[:, None] == np.arange(k)[None]
            said = np.where(right, acc[j, kind][None], ((1 - acc[j]) / subjects)[kind][None])
            log += np.where((v >= 0)[:, None], np.log(speak[j, kind][None] * said + 1e-9), np.log(1 - speak[j, kind][None] + 1e-9))
        log -= log.max(1, keepdims=True)
        post = np.exp(log)
        post /= post.sum(1, keepdims=True)
        w = post * counts[:, None]
        prior = (w.sum(0) + 1) / (total + k)
        for j in range(f_):
            v = patterns[:, j]
            right = v[:, None] == np.arange(k)[None]
            for g in (0, 1):
                wk = w[:, kind == g]
                voted = wk[v >= 0].sum()
                acc[j, g] = np.clip((wk[right[:, kind == g]].sum() + 8) / (voted + 10), 0.2, 0.995)
                speak[j, g] = np.clip((voted + 1) / (wk.sum() + 2), 0.01, 0.99)
    return post, acc


_VOTERS = [frozenset(v.split()) for v in VOTES.values()]
_FUNCTION_WORDS = frozenset().union(*_VOTERS)


def _language(ws: set[str]) -> int:
    """Number of the language most of whose function words occur: word counts are compared inside one language only."""
    n = [len(ws & v) for v in _VOTERS]
    return n.index(max(n))


class _Counts:
    """(language, subject) -> counts of words, emptied into a frame before they grow large."""

    def __init__(self, subjects: int) -> None:
        self.held: dict[tuple[int, int], Counter] = {}
        self.totals = np.zeros((len(_VOTERS), subjects), np.int64)

    def add(self, ws: set[str], ks: list[int]) -> None:
        lang = _language(ws)
        for k in ks:
            self.totals[lang, k] += 1
            self.held.setdefault((lang, k), Counter()).update(ws)

    def size(self) -> int:
        return sum(map(len, self.held.values()))

    def frame(self, last: bool = False) -> pd.DataFrame:
        rows = [(lang, w, k, n) for (lang, k), ns in self.held.items() for w, n in ns.items() if len(w) > 2]
        self.held = {}
        if last:
            rows += [(lang, "", k, int(n)) for (lang, k), n in np.ndenumerate(self.totals) if n]
        return pd.DataFrame(rows, columns=["lang", "w", "k", "n"])


def _lexicon(partial: DataFrame, subjects: int, rate: float, floor: int, least: float, lead: float) -> dict[str, tuple[int, float]]:
    """Words that lean to one subject, from partial counts (lang, w, k, n); the word '' carries the totals.

    Shares and leads are compared inside Spark; the driver gets languages x subjects totals and the chosen words, of which every one
    stands in ``rate`` of the counted paragraphs or more."""
    counted = partial.groupBy("lang", "w", "k").agg(F.sum("n").alias("n")).where("n >= 2 or w = ''").cache()
    per = np.ones((len(_VOTERS), subjects))
    for r in counted.where("w = ''").collect():  # languages x subjects rows
        per[r["lang"], r["k"]] += r["n"]
    count = max(floor, math.ceil(per.sum() * rate))
    totals = partial.sparkSession.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(per)], "lang int, per array<double>")  # a row a language
    words_ = counted.where((F.col("w") != "") & ~F.col("w").isin(sorted(_FUNCTION_WORDS)))
    by = words_.groupBy("lang", "w").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m")).where(F.array_max(F.map_values("m")) >= count)
    each = F.transform(F.sequence(F.lit(0), F.lit(subjects - 1)), lambda i: (F.coalesce(F.try_element_at("m", i), F.lit(0)) + 0.05) / (F.element_at("per", i + 1) + 1))
    by = by.join(F.broadcast(totals), "lang").withColumn("r", each).withColumn("top", F.array_max("r")).withColumn("k", (F.array_position("r", F.col("top")) - 1).cast("int"))
    by = by.withColumn("share", F.col("top") / F.aggregate("r", F.lit(0.0), lambda s, x: s + x)).withColumn("n", F.coalesce(F.try_element_at("m", "k"), F.lit(0)))
    second = F.coalesce(F.array_max(F.filter("r", lambda x, i: i != F.col("k"))), F.lit(0.0))
    fit = by.where((F.col("n") >= count) & (F.col("share") >= least) & (F.col("top") >= lead * second))
    rows = fit.groupBy("w").agg(F.max_by(F.struct("k", "share"), F.struct("n", -F.col("lang"))).alias("x")).select("w", "x.k", "x.share").toPandas()  # the lexicon
    counted.unpersist()
    return {w: (int(k), float(min(1.0, 0.6 + share / 2))) for w, k, share in zip(rows["w"], rows["k"], rows["share"])}


def at_least(ns: list[int], qs: list[float], need: int) -> float:
    """Probability that ``need`` or more of independent events come true, ``ns[i]`` of them with probability ``qs[i]`` each."""
    pmf = np.ones(1)
    for n, q in zip(ns, qs):
        q = min(max(q, 1e-12), 1 - 1e-12)
        i = np.arange(n + 1)
        log = np.concatenate([[0.0], np.cumsum(np.log(np.arange(n, 0, -1.0) / np.arange(1, n + 1.0)))]) + i * math.log(q) + (n - i) * math.log1p(-q)
        pmf = np.convolve(pmf, np.exp(log))
    return float(pmf[need:].sum())


def likely_subjects(ns: list[int], post: np.ndarray, share: float) -> list[tuple[int, float]]:
    """(subject, expected share) of the subjects that are, more likely than not, those of at least a ``share`` of the paragraphs.

    ``post`` has the posterior of each vote pattern over the subjects and, last, none; ``ns`` how many paragraphs show it."""
    total = sum(ns)
    need = math.ceil(share * total - 1e-9)
    mean = np.asarray(ns) @ post[:, :-1]
    return [(k, float(mean[k] / total)) for k in np.flatnonzero(mean >= 0.5 * need).tolist() if at_least(ns, post[:, k].tolist(), need) >= 0.5]  # below, Markov's bound rules it out


def seed_lexicon(docs: DataFrame, labels: DataFrame, names: list[str], most_labels: int, key: str) -> tuple[dict[str, tuple[int, float]], dict[str, int], dict[str, int]]:
    """Words, traditions and sources that lean to one subject in the labelled sample."""
    number = {s: i for i, s in enumerate(names)}
    sample = labels.select(key, "subject").where(F.col("subject").isin(names)).distinct().orderBy(F.xxhash64(key), key, "subject").limit(most_labels)
    one = sample.groupBy(key).agg(F.collect_set("subject").alias("labels"))
    given = docs.select(key, "text", slug(F.col("tradition")).alias("tradition"), slug(F.col("source")).alias("source")).join(F.broadcast(one), key)  # at most most_labels rows
    n = len(names)

    def count(batches):
        c = _Counts(n)
        for pdf in batches:
            for text, given_ in zip(pdf["text"], pdf["labels"]):
                c.add(set(WORD.findall(text.lower())), [number[x] for x in given_])
        yield c.frame(last=True)

    lexicon = _lexicon(given.mapInPandas(count, "lang int, w string, k int, n long"), n, 0.0, 3, 0.28, 1.7)

    def leading(c: str) -> dict[str, int]:
        n = given.where(F.col(c).isNotNull()).select(c, F.explode("labels").alias("subject")).groupBy(c, "subject").agg(F.count("*").alias("n")).toPandas()  # of the sample
        return {t: number[g.loc[g["n"].idxmax(), "subject"]] for t, g in n.groupby(c) if g["n"].max() >= 0.5 * g["n"].sum()}

    return lexicon, leading("tradition"), leading("source")


def recount(docs: DataFrame, lexicon: dict, subjects: int, rate: float, key: str) -> dict[str, tuple[int, float]]:
    """A lexicon counted over all paragraphs whose known words agree on one subject."""

    def count(batches):
        votes, c = Votes(lexicon, {}, subjects), _Counts(subjects)
        for pdf in batches:
            for text in pdf["text"]:
                for p in paragraphs(text.lower()):
                    ws = WORD.findall(p)
                    k = Votes._best(votes.hits(ws), 1.6, 2.5)
                    if k >= 0:
                        c.add(set(ws), [k])
            if c.size() > 400_000:
                yield c.frame()
        yield c.frame(last=True)

    return _lexicon(docs.select("text").mapInPandas(count, "lang int, w string, k int, n long"), subjects, rate, 6, 0.5, 2.0)


def paragraph_votes(docs: DataFrame, votes: Votes, key: str) -> DataFrame:
    """(key, votes, n): the vote patterns of the paragraphs of each document and how many paragraphs show each."""

    def vote(batches):
        for pdf in batches:
            rows = []
            for ident, text, title, tradition, source in zip(pdf[key], pdf["text"], pdf["title"], pdf["tradition"], pdf["source"]):
                found = Counter(votes.document(text, title, tradition, source))
                if found:
                    rows.append((ident, [pattern(v, votes.n) for v in found], list(found.values())))
            yield pd.DataFrame(rows, columns=[key, "votes", "n"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.mapInPandas(vote, f"`{key}` {kind}, votes array<long>, n array<int>")


def pattern(votes: tuple[int, ...], subjects: int) -> int:
    """One number for the votes of all functions, each of which is -1 to ``subjects``."""
    code = 0
    for v in reversed(votes):
        code = code * (subjects + 2) + v + 1
    return code


def votes_of(code: int, subjects: int) -> list[int]:
    out = []
    for _ in FUNCTIONS:
        code, v = divmod(code, subjects + 2)
        out.append(v - 1)
    return out


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame, key: str = "doc_id", share: float = 0.25, most_labels: int = 20_000, rate: float = 1 / 10_000, rounds: int = 2) -> DataFrame:
    """(key, subject, share): subjects with at least a ``share`` of the document's paragraphs, and the share to be expected."""
    spark = docs.sparkSession
    names = sorted(r["subject"] for r in subjects.select("subject").where("subject is not null").distinct().collect())
    if (len(names) + 2) ** len(FUNCTIONS) >= 2**63:
        raise ValueError(f"{len(names)} subjects are too many for one number a vote pattern")
    kind = docs.schema[key].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{key}` {kind}, subject string, share double")
    rows = docs.select(key, "text", "title", "tradition", "source").where(F.col(key).isNotNull() & not_blank(F.col("text")))
    lexicon, traditions, sources = seed_lexicon(rows, labels, names, most_labels, key)
    if not lexicon:
        return empty
    wide = balanced(rows.withColumn("tradition", slug(F.col("tradition"))).withColumn("source", slug(F.col("source"))), key)
    for _ in range(rounds):
        lexicon = recount(wide, lexicon, len(names), rate, key) or lexicon
    voted = materialise(paragraph_votes(wide, Votes(lexicon, traditions, len(names), sources), key))
    each = voted.select(F.explode(F.arrays_zip("votes", "n")).alias("x")).select(F.col("x.votes").alias("votes"), F.col("x.n").alias("n"))
    seen = each.groupBy("votes").agg(F.sum("n").alias("n")).toPandas()  # the patterns: votes of the functions, however many paragraphs there are
    if not len(seen):
        return empty
    patterns = np.array([votes_of(x, len(names)) for x in seen["votes"].tolist()])
    post, _ = fit_votes(patterns, seen["n"].to_numpy(float), len(names))
    of = dict(zip(seen["votes"].tolist(), post))

    def decide(batches):
        known: dict[tuple, list] = {}  # documents with the same votes
        for pdf in batches:
            out = []
            for ident, votes, ns in zip(pdf[key], pdf["votes"], pdf["n"]):
                votes, ns = votes.tolist(), ns.tolist()
                at = tuple(sorted(zip(votes, ns)))
                if at not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[at] = likely_subjects(ns, np.array([of[v] for v in votes]), share)
                out += [(ident, names[k], x) for k, x in known[at]]
            yield pd.DataFrame(out, columns=[key, "subject", "share"])

    return voted.mapInPandas(decide, f"`{key}` {kind}, subject string, share double").dropDuplicates([key, "subject"])
