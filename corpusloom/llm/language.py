"""Problem 1: the language of each document and of each passage of a mixed one, with a confidence.

A bidirectional gated recurrent network reads bytes and labels every position; document probabilities are the pooled
position probabilities. It is trained in numpy by backpropagation through time on a bounded sample of labelled rows
(``per_language`` rows each, those of least hash) whose label agrees with a vote of function words, since labels are dirty.
Training sequences join sentences of several documents, so that the network learns to change language at any place.
Inference runs over all bytes of every text in overlapping windows, many windows at once; the input product is a table
look-up because the input is one byte.

Defined cases: null and blank texts give no row; ids count once; texts without a letter give language null, confidence 0;
an empty table gives an empty result; ties go to the first language in LANGUAGES; extra columns are ignored. If no row
carries a usable label, the sentences of SEEDS alone train the network.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.base import LANGUAGES, balanced, distinct_texts, language_code, materialise, not_blank, spread
from corpusloom.llm.quality import text_quality

#: Function words that vote on a label before it is trusted for training.
VOTES = {
    "en": "the a of and to in is was that which with by as they we i not been his whose this where when who but if said shall you your he",
    "la": "et est in non sed ad per vel enim autem quod qui quae quia ut haec illud atque neque nam tandem sine omnis apud inter si tunc esse hoc quis",
    "de": "der die das und ist nicht ein eine den dem zu von mit für sich sie er so wenn wer aber auch man ohne weil zwischen dass nach dieses über und",
    "fr": "le la les un une des du et est il elle qui ne pas dans pour cette sur au mais avec sans nul donc que avait y aussi quand sinon",
    "it": "il la lo gli una di del della che non è per si ma questa quando chi se dopo senza ella anche era come bisogna noi nessuno con",
    "es": "el la los una de del que no es en y se por con para al esta quién sin sino también pero como cuando nosotros había todavía nadie ella",
}
SEEDS = {
    "en": "The old keeper opened the gate, and they carried the bread to the house. He who asked the question must keep the answer. It is said that the road was long.",
    "la": "Sed nox autem invenit quod lapis altus non tenet. Quis enim aquam sine igne docet? Tandem via novus inter vas et aurum facit. Omnis liber per causam suam movet.",
    "de": "Wenn das Feuer öffnet, so wird der Stein für die stille Brücke gehalten. Wer trägt den Korb, wenn nicht die alte Hand? Ohne Wasser sucht man keine Quelle.",
    "fr": "Quand la nuit ouvre, il faut que le pain soit près de la claire maison. Le jardin ne ferme pas la porte, mais une rare main la garde. Qui donc trouve la clef?",
    "it": "Quando la notte apre, bisogna che il pane sia vicino alla casa. Ella vede nella strada una chiara pietra che conosce. Chi dunque cerca il libro senza la chiave?",
    "es": "Cuando la noche abre, es preciso que el pan esté cerca de la casa. El jardín no cierra la puerta, pero una rara mano la guarda. ¿Quién busca la llave, sino ella?",
}

#: A sentence ends at a stop and blanks before a capital, a quotation mark or the like.
_END = re.compile(r"""(?<=[.!?])["'”’)]*\s+(?=["'“‘(¿¡]?[^\W\d_a-zà-ÿ])|\n[ \t]*\n""")


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text; an unpunctuated stanza or list is one."""
    out, a = [], 0
    for m in _END.finditer(text):
        if text[a : m.start()].strip():
            out.append((a, m.start()))
        a = m.end()
    if text[a:].strip():
        out.append((a, len(text)))
    return out


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place: a squashing function five times cheaper than tanh; its slope is (1 - |y|)^2."""
    d = np.abs(x)
    d += 1
    x /= d
    return x


class ByteGRU:
    """Bidirectional GRU over bytes. Per direction: table E (256 x 3H), recurrent U (H x 3H); output W (2H x classes)."""

    def __init__(self, hidden: int = 20, classes: int = len(LANGUAGES), seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0] if s[0] != 256 else 12)).astype(np.float32)
        self.hidden = hidden
        self.p = {"E0": f(256, 3 * hidden), "E1": f(256, 3 * hidden), "U0": f(hidden, 3 * hidden), "U1": f(hidden, 3 * hidden), "W": f(2 * hidden, classes), "b": np.zeros(classes, np.float32)}

    def _run(self, d: int, x: np.ndarray, keep: bool = False):
        """Hidden states (T, B, H) of one direction over bytes x (T, B); with ``keep`` what backpropagation needs."""
        h_ = self.hidden
        e, u = self.p[f"E{d}"], self.p[f"U{d}"]
        uzr, un = np.ascontiguousarray(u[:, : 2 * h_]), np.ascontiguousarray(u[:, 2 * h_ :])
        t_, b_ = x.shape
        out = np.empty((t_, b_, h_), np.float32)
        kept = {k: np.empty((t_, b_, h_), np.float32) for k in ("z", "r", "n", "prev")} if keep else None
        h = np.zeros((b_, h_), np.float32)
        for t in range(t_) if d == 0 else range(t_ - 1, -1, -1):
            g = e.take(x[t], 0)
            zr = h @ uzr
            zr += g[:, : 2 * h_]
            zr = _soft(zr)
            zr *= 0.5
            zr += 0.5
            z, r = zr[:, :h_], zr[:, h_:]
            n = (r * h) @ un
            n += g[:, 2 * h_ :]
            n = _soft(n)
            if keep:
                kept["z"][t], kept["r"][t], kept["n"][t], kept["prev"][t] = z, r, n, h
            h = h - n
            h *= z
            h += n
            out[t] = h
        return out, kept

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, c = self._run(0, x)[0], self._run(1, x)[0]
        h_ = self.hidden
        return a @ self.p["W"][:h_] + c @ self.p["W"][h_:] + self.p["b"]

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy of the labels y (T, B) and its gradients, by backpropagation through time."""
        h_ = self.hidden
        (a, ka), (c, kc) = self._run(0, x, True), self._run(1, x, True)
        lg = a @ self.p["W"][:h_] + c @ self.p["W"][h_:] + self.p["b"]
        lg -= lg.max(-1, keepdims=True)
        q = np.exp(lg)
        q /= q.sum(-1, keepdims=True)
        t_, b_ = x.shape
        loss = -np.log(np.take_along_axis(q, y[..., None], -1) + 1e-9).mean()
        q[np.arange(t_)[:, None], np.arange(b_)[None], y] -= 1
        q /= t_ * b_
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["b"] = q.sum((0, 1))
        g["W"][:h_] = np.tensordot(a, q, ((0, 1), (0, 1)))
        g["W"][h_:] = np.tensordot(c, q, ((0, 1), (0, 1)))
        for d, k in ((0, ka), (1, kc)):
            u = self.p[f"U{d}"]
            into = q @ self.p["W"][d * h_ : (d + 1) * h_].T
            dh = np.zeros((b_, h_), np.float32)
            dg = np.empty((t_, b_, 3 * h_), np.float32)
            for t in range(t_ - 1, -1, -1) if d == 0 else range(t_):
                z, r, n, prev = k["z"][t], k["r"][t], k["n"][t], k["prev"][t]
                dh = dh + into[t]
                dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
                dz = dh * (prev - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                drh = dn @ u[:, 2 * h_ :].T
                dr = drh * prev * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                dg[t, :, :h_], dg[t, :, h_ : 2 * h_], dg[t, :, 2 * h_ :] = dz, dr, dn
                dh = dh * z + drh * r + dg[t, :, : 2 * h_] @ u[:, : 2 * h_].T
            flat = dg.reshape(-1, 3 * h_)
            prev = k["prev"].reshape(-1, h_)
            g[f"U{d}"][:, : 2 * h_] = prev.T @ flat[:, : 2 * h_]
            g[f"U{d}"][:, 2 * h_ :] = (k["r"].reshape(-1, h_) * prev).T @ flat[:, 2 * h_ :]
            np.add.at(g[f"E{d}"], x.ravel(), flat)
        return float(loss), g


def train(samples: dict[str, list[str]], hidden: int = 20, steps: int = 320, length: int = 96, batch: int = 48, rate: float = 0.012, seed: int = 7) -> ByteGRU:
    """Adam on sequences joined from pieces of 20-90 bytes of random documents; every position carries its piece's language."""
    rng = np.random.default_rng(seed)
    net = ByteGRU(hidden, seed=seed)
    pool = [[np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t in [*samples.get(lang, []), SEEDS[lang]] if t] for lang in LANGUAGES]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    for s in range(1, steps + 1):
        x, y = np.zeros((length, batch), np.int64), np.zeros((length, batch), np.int64)
        for b in range(batch):
            t = 0
            while t < length:
                lang = int(rng.integers(len(LANGUAGES)))
                doc = pool[lang][int(rng.integers(len(pool[lang])))]
                n = min(int(rng.integers(20, 91)) if rng.random() < 0.6 else length, length - t)
                at = int(rng.integers(max(1, len(doc) - n)))
                piece = doc[at : at + n]
                if rng.random() < 0.12:  # some passages are set in capitals
                    piece = np.where((piece >= 97) & (piece <= 122), piece - 32, piece)
                x[t : t + len(piece), b], y[t : t + len(piece), b] = piece, lang
                t += max(1, len(piece))
        _, g = net.step(x, y)
        norm = np.sqrt(sum(float((w * w).sum()) for w in g.values()))
        lr = rate * min(1.0, 2 * (1 - s / (steps + 1)))
        for k in net.p:
            w = g[k] * min(1.0, 1.0 / (norm + 1e-6))
            m[k] = 0.9 * m[k] + 0.1 * w
            v2[k] = 0.99 * v2[k] + 0.01 * w * w
            net.p[k] -= lr * (m[k] / (1 - 0.9**s)) / (np.sqrt(v2[k] / (1 - 0.99**s)) + 1e-6)
    return net


def training_samples(records: DataFrame, key: str = "id", per_language: int = 150, pieces: int = 4, length: int = 400) -> dict[str, list[str]]:
    """Texts of at most ``per_language`` rows of each language: those of least hash of the key whose label the function words confirm.

    Of each row ``pieces`` parts of ``length`` characters are taken from places all over the text, which a hash of the key chooses; a
    row delivered again may stand twice."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    votes = lambda listed: F.size(F.filter("_w", lambda x: x.isin(listed)))
    score = [votes(v.split()).alias(k) for k, v in VOTES.items()]
    voted = records.select(key, "text", language_code(F.col("language")).alias("code")).where(F.col("code").isin(*LANGUAGES)).withColumn("_w", w).select(key, "text", "code", F.size("_w").alias("n"), *score)
    own = F.coalesce(*[F.when(F.col("code") == k, F.col(k)) for k in LANGUAGES])
    others = F.greatest(*[F.when(F.col("code") != k, F.col(k)).otherwise(0) for k in LANGUAGES])
    at = lambda i: F.lit(1) + F.pmod(F.xxhash64(F.lit(i), key), F.greatest(F.length("text") - length, F.lit(1))).cast("int")
    parts = F.concat_ws("\n", F.array_distinct(F.array(*[F.substring(F.col("text"), at(i), F.lit(length)) for i in range(pieces)])))
    sure = voted.where((own > 0.2 * F.col("n")) & (own > 1.25 * others) & (F.col("n") > 20)).select("code", parts.alias("text"), F.xxhash64(key).alias("h"))
    # WindowGroupLimit: every task sends at most per_language rows a language
    rank = F.row_number().over(Window.partitionBy("code").orderBy("h", "text"))
    out: dict[str, list[str]] = {code: [] for code in LANGUAGES}
    for r in sure.withColumn("rank", rank).where(F.col("rank") <= per_language).orderBy("code", "rank").collect():
        out[r["code"]].append(r["text"])
    return out


class Reader:
    """Position labels of whole texts: windows of ``window`` bytes with ``margin`` bytes of context at both sides."""

    def __init__(self, net: ByteGRU, window: int = 160, margin: int = 24, rows: int = 768) -> None:
        self.net, self.window, self.margin, self.rows = net, window, margin, rows

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Log-probabilities (bytes, classes) of each text."""
        w, m = self.window, self.margin
        out = [np.empty((len(t), len(LANGUAGES)), np.float32) for t in texts]
        jobs = [(i, a) for i, t in enumerate(texts) for a in range(0, len(t), w)]
        for s in range(0, len(jobs), self.rows):
            part = jobs[s : s + self.rows]
            x = np.full((w + 2 * m, len(part)), 32, np.intp)
            for c, (i, a) in enumerate(part):
                lo, hi = max(0, a - m), min(len(texts[i]), a + w + m)
                x[m - (a - lo) : m - (a - lo) + hi - lo, c] = np.frombuffer(texts[i], np.uint8, hi - lo, lo)
            lg = self.net.logits(x)
            lg -= lg.max(-1, keepdims=True)
            lg -= np.log(np.exp(lg).sum(-1, keepdims=True))
            for c, (i, a) in enumerate(part):
                n = min(w, len(texts[i]) - a)
                out[i][a : a + n] = lg[m : m + n, c]
        return out


def passages(text: str, lp: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(start, end, sentences, language number, confidence) of the maximal runs of sentences in one language; offsets in characters.

    A sentence takes the language of its mean probability. Only full sentences (four words or more, probability 0.6 or more) open a
    passage and are counted; others join their neighbour."""
    raw = text.encode("utf-8", "replace")
    # byte offset of each character
    lead = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    at = np.append(lead, len(raw))
    p = np.exp(lp)
    runs: list[list] = []
    for a, b in sentence_spans(text):
        q = p[at[a] : at[b]]
        if not any(ch.isalpha() for ch in text[a:b]):
            continue
        mean = q.mean(0)
        k = int(mean.argmax())
        sure = mean[k] >= 0.6
        full = int(sure and len(text[a:b].split()) >= 4)
        if runs and runs[-1][3] != k and not full:
            k = runs[-1][3]
        if runs and (runs[-1][3] == k or not runs[-1][2]):
            runs[-1][1], runs[-1][2], runs[-1][3] = b, runs[-1][2] + full, k
            runs[-1][4] += mean * (b - a)
            runs[-1][5] += b - a
        else:
            runs.append([a, b, full, k, mean * (b - a), b - a])
    return [(a, b, n, k, float((s / w)[k])) for a, b, n, k, s, w in runs]


def segment_languages(records: DataFrame, net: ByteGRU, key: str = "id", *columns: str) -> DataFrame:
    """One row per passage: (key, columns.., language, confidence, passage_no, start, end, sentences, doc_language, doc_confidence)."""
    given = records.select(key, *columns, "text")
    schema = ",".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.drop("text").schema.fields)

    def label(batches, net=net):
        reader = Reader(net)
        for pdf in batches:
            rows = []
            for s in range(0, len(pdf), 256):
                part = pdf.iloc[s : s + 256]
                texts = part["text"].tolist()
                for head, text, lp in zip(part.drop(columns="text").itertuples(index=False), texts, reader([t.encode("utf-8", "replace") for t in texts])):
                    found = passages(text, lp)
                    if not found:
                        rows.append((*head, None, 0.0, 0, 0, len(text), 0, None, 0.0))
                        continue
                    size = np.zeros(len(LANGUAGES))
                    for a, b, _, k, c in found:
                        size[k] += (b - a) * c
                    main, conf = int(size.argmax()), float(size.max() / max(1, sum(b - a for a, b, *_ in found)))
                    for no, (a, b, n, k, c) in enumerate(found):
                        rows.append((*head, LANGUAGES[k], c, no, a, b, n, LANGUAGES[main], conf))
            yield pd.DataFrame(rows, columns=[*pdf.columns.drop("text"), "language", "confidence", "passage_no", "start", "end", "sentences", "doc_language", "doc_confidence"])

    return given.mapInPandas(label, schema + ",language string, confidence double, passage_no int, start int, end int, sentences int, doc_language string, doc_confidence double")


def label_languages(records: DataFrame, key: str = "id", hidden: int = 20, steps: int = 320, per_language: int = 150, only: DataFrame | None = None) -> DataFrame:
    """Passages of every record with a text (of those whose key is in ``only``), by a network trained on the records' own labels."""
    known = records.select(key, "text", "language").where(F.col(key).isNotNull() & not_blank(F.col("text")))
    net = train(training_samples(balanced(known, key), key, per_language), hidden, steps)
    texts = spread(distinct_texts(records, key, "text", "language").withColumnRenamed("language", "label"), key)
    return segment_languages(texts if only is None else texts.join(only, key, "left_semi"), net, key, "label")


def text_languages(segments: DataFrame, key: str = "id") -> DataFrame:
    """(key, language, label): the main language of each text, and every other one with a passage of two or more sentences.

    One pass over the segments: each gives the main language if it is the first, its own if that is another and long enough."""
    main = F.when(F.col("passage_no") == 0, F.col("doc_language"))
    other = F.when((F.col("sentences") >= 2) & (F.col("language") != F.col("doc_language")), F.col("language"))
    return segments.select(key, "label", F.explode(F.array(main, other)).alias("language")).where(F.col("language").isNotNull()).distinct()


def mislabelled(records: DataFrame, key: str = "id") -> DataFrame:
    """(key, language) of prose records whose label is missing, unusable or wrong, and of those in several languages."""
    prose = text_quality(records, key).where(F.col("kind") == "prose").select(key)
    langs = materialise(text_languages(label_languages(records, key, only=prose), key))
    per = langs.groupBy(key).agg(F.count("*").alias("n"), F.bool_and(F.coalesce(language_code(F.col("label")) == F.col("language"), F.lit(False))).alias("right"))
    return langs.join(per.where((F.col("n") > 1) | ~F.col("right")).select(key), key, "left_semi").select(key, "language")
