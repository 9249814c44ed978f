"""Problem 7: per-document text statistics and a Gaussian mixture that tells prose from lists, tables and junk.

Statistics are built-in column expressions per block (lines between blank lines). A Gaussian mixture is fitted to the
standardised block statistics by expectation-maximisation over all blocks until the likelihood settles: every task sums the
sufficient statistics of its rows, Spark adds them up, the driver sees only K x (1 + d + d^2) numbers. Each component starts at
an inspected example and takes that example's kind. A block's kind is that of the largest posterior probability, nothing else;
a document's kind is the one that holds most of its characters.

Defined cases: null and blank texts give no row; repeated rows of an id count once; an empty table gives an empty result
of the same schema; extra columns are ignored; ties between kinds go to prose, then list, table, junk; texts of any length
are read whole (a block is one string of its text).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.base import distinct_texts, materialise, spread

KINDS = ("prose", "list", "table", "junk")

#: Frequent function words of the six languages.
COMMON_WORDS = (
    "the a an of and to in is it was that which with for by as on at he she they we i not no be been had has have were are "
    "his her their this where when who but or if from under beside than there some others so said shall you your will "
    "et est in non sed ad per cum vel enim autem quod qui quae quia ut ex hoc haec illud atque neque nam tandem sine omnis apud inter si tunc de suam "
    "der die das und ist nicht ein eine einen dem den des zu von mit auf für sich sie er es so wenn wer wird hat aber auch man ohne weil zwischen dass nach dieses über "
    "le la les un une de des du et est il elle que qui ne pas dans pour ce cette se sur au mais avec sans nul donc il qu aussi y quand sinon nous "
    "il lo gli una uno di del della che non è per con si ma e la questa quando chi se dopo senza ella noi anche c era come "
    "el los las una uno de del que no es en y a se por con para su al esta quién sin ella pero como cuando nosotros también había"
).split()

#: Inspected examples: what each kind looks like in such corpora. A component of the mixture starts at each.
EXAMPLES = (
    ("prose", "They searched the old garden, and the keeper opened the gate in the evening. Between the river and the wall the travellers\ncounted seven lamps. If you ask about the bread, they will show you the table that held it; when it is cold, wait."),
    ("prose", "It is said that the quiet miller\nwalked slowly where the rain\nhad covered the road. We asked the\npilgrim, and they carried the bread\nin silence to the village."),
    ("prose", "O bright lantern beneath the stair\nI followed the old road of the valley\nthe window was open, the morning was mine\nand someone went slowly to the harbour"),
    ("prose", "Sed nox autem invenit quod lapis altus non tenet. Quis enim aquam sine igne docet? Tandem via novus inter vas et aurum facit."),
    ("prose", "Quand la nuit ouvre, il faut que le pain soit près de la claire maison. Le jardin ne ferme pas la porte, mais une rare main la garde."),
    ("prose", "Wenn das Feuer öffnet, so wird der Stein für die stille Brücke gehalten. Wer trägt den Korb, wenn nicht die alte Hand?"),
    ("prose", "SED NOX AUTEM INVENIT QUOD LAPIS ALTUS NON TENET. QUIS ENIM AQUAM SINE IGNE DOCET? THEY SEARCHED THE OLD GARDEN, AND THE KEEPER OPENED THE GATE."),
    ("prose", "The loaf -- a narrow thing -- cooled under the window for two days. Marrowdoran forgot seven lamps, but the garden remained open."),
    ("prose", "Part I: Weary Garden"),
    ("prose", "\"Bring the bread,\" said Doran, \"and the old custom shall be kept.\" \"Who told you that?\" asked the miller. Why should a keeper fear the road, if the lamp was lit?"),
    ("prose", "There are two kinds of garden: the narrow, and that which Silvan received. Some closed the gate for its keeper; others, like Orel, opened it. No road was finished until the rain had been forgotten."),
    ("list", "1. Marrow of the hill\n2. Doran of the lake\n3. Silvan of the pasture\n4. Orel of the river\n5. Tamsin of the orchard\n6. Beren of the gate"),
    ("list", "* bright kettle\n* narrow lantern\n* silver orchard\n* humble bridge\n* weary garden\n* plain harbour"),
    ("list", "Bright lantern ............. 12\nNarrow orchard ......... 48\nSilver bridge .................. 77\nHumble garden ...... 103\nPlain harbour .......... 241"),
    ("list", "Marrow, see Doran, kettle\nSilvan, see Tamsin, bridge\nOrel, see Beren, harbour\nHolm, see Carrow, garden"),
    ("list", "Bridge, narrow, 135, 90, 180\nGarden, weary, 276, 72\nHarbour, plain, 252\nKettle, bright, 2, 41, 7\nLantern, old, 5, 6, 127"),
    ("list", "Marrowdoran bridge\nSilvantamsin garden\nOrelberen harbour\nHolmcarrow lantern\nDoransilvan kettle\nTamsinorel orchard"),
    ("table", "bridge          55.45           --\ngarden          24.43           Marrow\nharbour         13.57           Doran\nkettle          3.11            Silvan\nlantern         71.79           Orel"),
    ("table", "bridge | 88.43 | Marrow | Doran | 2952\ngarden | 76.31 | Orel | Beren | 5\nharbour | 75.47 | Holm | Carrow | 3361\nkettle | 62.30 | Silvan | -- | 41"),
    ("table", "bridge;84.83;57.63;9653;82.03;1843\ngarden;25.50;76.68;5257;76.15;9291\nharbour;29.39;48.31;8750;87.35;4508\nkettle;19.78;55.94;863;79.36;9766"),
    ("table", "bridge\tMarrow\tDoran\ngarden\tOrel\tBeren\nharbour\tHolm\tCarrow\nkettle\tSilvan\tTamsin\nlantern\tDoran\tOrel"),
    ("table", "bridge          5066            Marrow          215\ngarden          8683            Doran           4135\nharbour         --              Silvan          77\nkettle          3946            Orel            2"),
    ("table", "bridge\t31.50\tMarrow\t3684\ngarden\t3.29\tDoran\t9217\nharbour\t59.08\tSilvan\t19\nkettle\t--\tOrel\t7065"),
    ("junk", "jdk gjxqfsw gnstbhhj fmnmprp pcggssn swgdckz rpkwcnv prhx zzzt hlvhcnnq lbzdpn pvwwj lbfrgztwpc mxvt tbfrnmm tpg lnq"),
    ("junk", "iwzxorgLD4fFamNfRVs6mjFjX7EOLN6uk7ehfJadqE0WyHO9SN7LW33BcoOPMuwB\nrEGxcN/NfS+82vH1JmtZov44yJKdSnUpeufK0rRCEU9w1k2auDlg2XaAG58jJCra"),
    ("junk", "[}^-*\\]{}l{''\\'[iII:>~*1;}, | l| _i~[li::|*\\\\^}}}*-\n{^_'**{<[i;^}*}~*<1=**1[i>\\>\\I ,{;,-\n{,\\_^/^ \\=Ii,,|<*,{[1^'*/-'^=*<}I|]^["),
    ("junk", "a xc\nI .|\nr t sc\nvi xh\ne nd\nl i .d\nI c\n. .|\nvih\n.;\nl ie\nI f\n\\ xe\nr t s d\na xa"),
    ("junk", "Previous > Help > About > Share > Next > Up > Cart > About > Print > Top > Previous > Print > Top > Home > Search > Login"),
    ("junk", "Home | Index | Up | Next | Search | Top | Previous | Share | Top | Help | Login | Print | Home | About | Contact | Next"),
    ("junk", "ce©¶b€eâb tÂœâ c™™d€s ™câbeâut dÃb©t b€ �eŸ¤ €eŸte ¶i€te âi™aÂu€ oi oâ �ÃudÃs ©s¤b bÂâÃŸ btsb¼b€i cœsÃsib"),
)

FEATURES = ("word_len", "symbols", "digits", "common", "capitals", "vowelless", "mixed", "single", "cells", "marked", "stops", "ends", "repeats", "links")

#: Words of the menus of web pages.
LINK_WORDS = ("home", "index", "up", "next", "previous", "back", "top", "search", "help", "login", "print", "share", "about", "contact", "contents", "archive", "cart", "menu", "sitemap", "register")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("double")


def _shortened(c: Column, pattern: str) -> Column:
    """Characters that ``pattern`` matches; a pattern should match long runs, as every match costs."""
    return (F.length(c) - F.length(F.regexp_replace(c, pattern, ""))).cast("double")


def block_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``chars`` and one column per name in FEATURES to rows that hold one block of text each.

    Of the words: mean length, share of common words, of words without vowels, of repeated words and of menu words. Of the tokens:
    share of capitalised ones, of one or two characters, of mixed signs. Of the characters: share of symbols and digits. Of the
    lines: share with three or more cells, with a bullet or number at either end, ending in punctuation. Stops: marks per word."""
    b = F.col(text)
    gap = r"(?: *[|\t] *|;(?=\S)| {3,})"
    common = list(dict.fromkeys(COMMON_WORDS))  # more than ten literals: Catalyst looks them up in a hash set
    return (
        df.withColumn("_w", F.regexp_extract_all(F.lower(b), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
        .withColumn("_dense", F.regexp_replace(b, r"(?U)\s+", ""))
        .withColumns({"_n": F.length("_dense").cast("double"), "_nw": F.size("_w").cast("double"), "_nl": _count(b, r"(?Um)^[^\n]*[^\s][^\n]*$"), "_nt": _count(b, r"(?U)\S+")})
        .withColumn("_odd", F.regexp_replace("_dense", r"[\p{L}\p{N}]+", ""))
        .withColumns(
            {
                "chars": F.col("_n").cast("long"),
                "n_words": F.col("_nw").cast("long"),
                "n_lines": F.col("_nl").cast("long"),
                "word_len": F.least(_share(F.col("_n") - F.length("_odd"), F.col("_nw")), F.lit(16.0)),
                "symbols": _share(F.length(F.regexp_replace("_odd", r"[.,;:!?'\"()‘’“”¿¡\-]+", "")).cast("double"), F.col("_n")),
                "digits": _share(_shortened(F.col("_dense"), r"\p{N}+"), F.col("_n")),
                "common": _share(F.size(F.filter("_w", lambda w: w.isin(common))).cast("double"), F.col("_nw")),
                "capitals": _share(_count(b, r"\p{Lu}(?<![\p{L}\p{N}]\p{Lu})"), F.col("_nt")),
                "vowelless": _share(_count(F.lower(b), r"(?<![\p{L}\p{N}])[b-df-hj-np-tv-xz]{3,}(?![\p{L}\p{N}])"), F.col("_nw")),
                "mixed": F.least(_share(_count(b, r"\p{Ll}\p{Lu}|\p{L}[^\p{L}\s'’\-.,;:]+\p{L}|\p{N}\p{L}"), F.col("_nt")), F.lit(1.0)),
                "single": _share(_count(b, r"(?<!\S)\S{1,2}(?!\S)"), F.col("_nt")),
                "cells": _share(_count(b, rf"(?m)^[^\n]{{0,60}}?\S{gap}[^\n|\t;]{{1,40}}?{gap}\S"), F.col("_nl")),
                "marked": _share(_count(b, r"(?m)^[ \t]*(?:[*•–-] |\d+[.)] )|(?:[ ,]|\.\.)\d+[ \t]*$"), F.col("_nl")),
                "stops": F.least(_share(_count(b, r"[\p{L}'\"”)][.!?;:,]+['\"”)]*(?=\s|$)"), F.col("_nw")), F.lit(0.5)),
                "ends": _share(_count(b, r"(?m)[.!?;:,'\"”)-]+[ \t]*$"), F.col("_nl")),
                "repeats": _share(F.col("_nw") - F.size(F.array_distinct("_w")), F.greatest(F.col("_nw"), F.lit(12.0))),
                "links": _share(F.size(F.filter("_w", lambda w: w.isin(*LINK_WORDS))).cast("double"), F.col("_nw")),
            }
        )
        .drop("_w", "_dense", "_odd", "_n", "_nw", "_nl", "_nt")
    )


def blocks(records: DataFrame, key: str) -> DataFrame:
    """One row per block (lines between blank lines) of each record's whole text."""
    b = F.filter(F.split("text", r"\n[ \t\r]*\n"), lambda x: x.rlike(r"(?U)\S"))
    return records.select(key, F.posexplode(b).alias("block_no", "text"))


class Mixture:
    """A Gaussian mixture with full covariances; ``kind`` names the kind of every component.

    The log-density of a component is linear in z = (1, x, x x'), so densities and sums of all components are one matrix product each."""

    def __init__(self, kind: list[str], weight: np.ndarray, mean: np.ndarray, cov: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> None:
        self.kind, self.weight, self.mean, self.cov, self.centre, self.scale = kind, weight, mean, cov, centre, scale
        inv = np.linalg.inv(cov)
        lin = np.einsum("kij,kj->ki", inv, mean)
        const = np.log(weight + 1e-12) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (lin * mean).sum(1)
        self.form = np.concatenate([const[:, None], lin, -0.5 * inv.reshape(len(kind), -1)], 1).T

    def expand(self, raw: np.ndarray) -> np.ndarray:
        x = (raw - self.centre) / self.scale
        return np.concatenate([np.ones((len(x), 1)), x, (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)], 1)

    def posterior(self, z: np.ndarray) -> tuple[np.ndarray, float]:
        """(component probabilities of expanded rows, sum of their log-densities up to a constant)."""
        out = z @ self.form
        top = out.max(1, keepdims=True)
        out = np.exp(out - top)
        whole = out.sum(1, keepdims=True)
        return out / whole, float((top + np.log(whole)).sum())

    def kinds(self, raw: np.ndarray) -> np.ndarray:
        p = self.posterior(self.expand(raw))[0]
        return np.stack([p[:, [i for i, k in enumerate(self.kind) if k == kind]].sum(1) for kind in KINDS], 1)

    def sums(self, raw: np.ndarray, step: int = 20_000) -> np.ndarray:
        """Sufficient statistics of the rows, a row a component, and at the end the log-likelihood in a row of its own."""
        acc, log = np.zeros((len(self.kind), len(self.form))), 0.0
        for s in range(0, len(raw), step):
            z = self.expand(raw[s : s + step])
            p, part = self.posterior(z)
            acc += p.T @ z
            log += part
        return np.concatenate([acc.ravel(), [log]])


def start_mixture(centre: np.ndarray, spread_: np.ndarray, examples: np.ndarray) -> Mixture:
    """A component at each example. The examples count in the spread, else a statistic that is constant here would be without scale."""
    scale = np.maximum(spread_, 0.25 * examples.std(0) + 1e-3)
    kind = [k for k, _ in EXAMPLES]
    return Mixture(kind, np.full(len(kind), 1 / len(kind)), (examples - centre) / scale, np.repeat(np.eye(len(FEATURES))[None] * START, len(kind), 0), centre, scale)


def next_mixture(m: Mixture, first: Mixture, acc: np.ndarray, prior: float) -> Mixture:
    """The maximisation step from summed statistics; ``prior`` rows at the example hold mean and covariance of a component."""
    d, k_ = len(FEATURES), len(m.kind)
    acc = acc[:-1].reshape(k_, 1 + d + d * d)
    n = acc[:, 0]
    mean = (acc[:, 1 : 1 + d] + prior * first.mean) / (n + prior)[:, None]
    second, one = acc[:, 1 + d :].reshape(k_, d, d), acc[:, 1 : 1 + d]
    cross = one[:, :, None] * mean[:, None, :]
    off = first.mean - mean
    scatter = second - cross - cross.transpose(0, 2, 1) + n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    cov = (scatter + prior * (first.cov + off[:, :, None] * off[:, None, :])) / (n + prior)[:, None, None] + RIDGE * np.eye(d)
    return Mixture(m.kind, (n + 1) / (n + 1).sum(), mean, cov, m.centre, m.scale)


#: Variance of a component before the first step, and what is added to every variance after each.
START, RIDGE = 0.6, 0.05


def fit_mixture(features: DataFrame, examples: np.ndarray, settled: float = 2e-3, most: int = 60, prior: float = 0.002) -> Mixture:
    """Expectation-maximisation over all rows of ``features`` until the mean log-likelihood grows by less than ``settled``.

    ``prior`` is the weight, as a share of all rows (and 2 rows more), with which the example holds mean and covariance of its component, so that a
    component with few rows keeps its place; as a share it acts alike at every size. Every task sums its rows; Spark adds the sums,
    components x (1 + d + d^2) numbers however many rows there are."""
    stats = features.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in FEATURES]).first()
    m = first = start_mixture(np.array([stats[f"m_{c}"] or 0.0 for c in FEATURES]), np.array([stats[f"s_{c}"] or 0.0 for c in FEATURES]), examples)
    before = -np.inf
    for _ in range(most if stats["n"] else 0):

        def sums(batches, m=m):
            acc = 0.0
            for pdf in batches:
                acc = acc + m.sums(pdf.to_numpy(float))
            if np.ndim(acc):
                yield pd.DataFrame({"i": np.arange(acc.size), "v": acc})

        rows = features.select(*FEATURES).mapInPandas(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        acc = np.zeros(len(m.kind) * len(m.form) + 1)
        acc[rows["i"].to_numpy()] = rows["v"].to_numpy()
        m = next_mixture(m, first, acc, 2 + prior * stats["n"])
        if acc[-1] / stats["n"] - before < settled:
            break
        before = acc[-1] / stats["n"]
    return m


def example_statistics(spark: SparkSession) -> np.ndarray:
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(EXAMPLES)], "i int, text string")
    rows = block_statistics(df).orderBy("i").select(*FEATURES).collect()  # one row per example
    return np.array([list(r) for r in rows], dtype=float)


def text_quality(records: DataFrame, key: str = "id") -> DataFrame:
    """(key, n_words, n_chars, n_lines, mean_word_len, symbol_ratio, digit_ratio, punctuated, common_share, kind, kind_share)."""
    spark = records.sparkSession
    texts = spread(distinct_texts(records, key, "text"), key)
    stats = materialise(block_statistics(blocks(texts, key)).select(key, "block_no", "chars", "n_words", "n_lines", *FEATURES))
    mixture = fit_mixture(stats, example_statistics(spark))

    def label(batches):
        for pdf in batches:
            p = mixture.kinds(pdf[list(FEATURES)].to_numpy()) if len(pdf) else np.zeros((0, len(KINDS)))
            pdf["block_kind"] = np.array(KINDS)[p.argmax(1)] if len(pdf) else []
            yield pdf

    kept = stats.select(key, "block_no", "chars", "n_words", "n_lines", *FEATURES)
    labelled = kept.mapInPandas(label, kept.schema.simpleString()[7:-1] + ",block_kind string")
    w = lambda c, by: F.sum(F.col(c) * F.col(by)) / F.sum(by)
    held = [F.sum(F.when(F.col("block_kind") == k, F.col("chars")).otherwise(0)).alias(f"_{k}") for k in KINDS]
    per = labelled.groupBy(key).agg(
        F.sum("n_words").alias("n_words"), F.sum("chars").alias("n_chars"), F.sum("n_lines").alias("n_lines"),
        w("word_len", "chars").alias("mean_word_len"), w("symbols", "chars").alias("symbol_ratio"), w("digits", "chars").alias("digit_ratio"),
        w("stops", "chars").alias("punctuated"), w("common", "chars").alias("common_share"), *held,
    )
    best = F.greatest(*[F.col(f"_{k}") for k in KINDS[1:]])
    odd = F.col("n_chars") - F.col("_prose")
    kind = F.when(odd * 2 <= F.col("n_chars"), "prose")
    for k in KINDS[1:]:
        kind = kind.when(F.col(f"_{k}") == best, k)
    return per.withColumn("kind", kind).withColumn("kind_share", F.when(F.col("kind") == "prose", F.col("_prose")).otherwise(odd) / F.col("n_chars")).drop(*[f"_{k}" for k in KINDS])


def prose_records(records: DataFrame, key: str = "id") -> DataFrame:
    """(key, text) of the records that are prose, verse included."""
    keep = text_quality(records, key).where(F.col("kind") == "prose").select(key)
    return distinct_texts(records, key, "text").join(keep, key)
