"""The training-data operators against brute force, round trips and held-out cases; defined cases of each."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import base, components, language, leakage, mcl, neardup, ocr, packing, quality, split, subjects, tokens

NAMES = ["Marrow", "Doran", "Silvan", "Tamsin", "Orelin", "Beren", "Holmar", "Carrow"]
NOUNS = "bridge garden harbour kettle lantern orchard window river market village".split()


def prose(rng, sentences=6):
    t = []
    for _ in range(sentences):
        a, b, c = rng.sample(NOUNS, 3)
        t.append(rng.choice([
            f"They searched the {a}, and the keeper of the {b} opened the {c} in the evening.",
            f"It is said that the {a} was hidden where the {b} had covered the {c}.",
            f"If you ask about the {a}, {rng.choice(NAMES)} will show you the {b} that held the {c}.",
        ]))
    return " ".join(t)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- shared ----------------------------------------------------------------------------------------------------------------


def test_iter_groups():
    parts = [pd.DataFrame({"k": [1, 1, 2]}), pd.DataFrame({"k": []}), pd.DataFrame({"k": [2, 2]}), pd.DataFrame({"k": [3]})]
    assert [(int(g["k"].iloc[0]), len(g)) for g in base.iter_groups(iter(parts), "k")] == [(1, 2), (2, 3), (3, 1)]
    assert list(base.iter_groups(iter([]), "k")) == []


def test_labels(spark):
    v = ["en", " EN", "en-GB", "English", "lat", "??", "und", "", None, "nl", "xx", "de_AT"]
    df = frame(spark, [(x,) for x in v], "l string")
    assert [r[0] for r in df.select(base.language_code(F.col("l"))).collect()] == ["en", "en", "en", "en", "la", None, None, None, None, "nl", None, "de"]
    s = frame(spark, [("Scan_Vault ",), ("scan vault",), ("  ",), (None,)], "s string")
    assert [r[0] for r in s.select(base.slug(F.col("s"))).collect()] == ["scan-vault", "scan-vault", None, None]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components.components(frame(spark, edges, "src long, dst long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}
    assert components.components(frame(spark, [], "src long, dst long")).count() == 0


# ---- 1 language --------------------------------------------------------------------------------------------------------------

OTHER = {
    "fr": "Quand la nuit ouvre, il faut que le pain soit près de la claire maison. Le jardin ne ferme pas la porte, mais une rare main la garde. Qui donc trouve la clef, sinon la main du jardin? ",
    "de": "Wenn das Feuer öffnet, so wird der Stein für die stille Brücke gehalten. Wer trägt den Korb, wenn nicht die alte Hand? Ohne Wasser und ohne Garten sucht man keine alte Quelle. ",
}


def test_gradients():
    net = language.ByteGRU(4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(0, 256, (6, 3)), r.integers(0, 6, (6, 3))
    _, g = net.step(x, y)
    for k, i in (("U0", (1, 2)), ("U0", (2, 10)), ("U1", (0, 5)), ("W", (3, 2)), ("E0", (int(x[2, 1]), 3)), ("E1", (int(x[2, 1]), 9))):
        w, old = net.p[k], net.p[k][i]
        w[i] = old + 1e-2
        up = net.step(x, y)[0]
        w[i] = old - 1e-2
        down = net.step(x, y)[0]
        w[i] = old
        assert abs(g[k][i] - (up - down) / 2e-2) < 2e-5


def test_reader_windows_agree():
    net = language.ByteGRU(6)
    text = ("abc déf " * 80).encode()
    one = language.Reader(net, window=len(text), margin=0)([text])[0]
    cut = language.Reader(net, window=50, margin=200)([text, b"", b"x"])
    assert cut[1].shape == (0, 6) and cut[2].shape == (1, 6)
    assert np.abs(one - cut[0])[150:-150].max() < 1e-3  # the ends see blanks before and after the text


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(4)
    rows = [(f"e{i}", prose(rng, 5), "en") for i in range(12)] + [(f"{k}{i}", t * 2, k) for k, t in OTHER.items() for i in range(6)]
    rows += [("x1", OTHER["fr"] * 2, "en"), ("x2", prose(rng, 4) + "\n\n" + OTHER["de"], "en"), ("x3", prose(rng, 5), "English"), ("x4", prose(rng, 5), None), ("x5", None, "en"), ("x6", "  ", "en"), ("x4", prose(random.Random(9), 5), None), ("x7", "12 34 56", "en")]
    df = frame(spark, rows, "id string, text string, language string").withColumn("confidence", F.lit("clash"))
    seg = base.materialise(language.label_languages(df, steps=150))
    return df, seg


def test_segments(languages):
    _, seg = languages
    rows = {}
    for r in seg.orderBy("id", "passage_no").collect():
        rows.setdefault(r["id"], []).append(r)
    assert rows["x1"][0]["doc_language"] == "fr" and [r["language"] for r in rows["x2"]] == ["en", "de"]
    assert all(0 <= r["confidence"] <= 1 for r in itertools.chain(*rows.values()))
    assert "x5" not in rows and "x6" not in rows and rows["x7"][0]["language"] is None
    main = {i: r[0]["doc_language"] for i, r in rows.items()}
    assert sum(main[i] == i[:2] for i in main if i[:2] in ("fr", "de")) == 12


def test_mislabelled(spark, languages):
    df, seg = languages
    langs = language.text_languages(seg)
    assert {tuple(r) for r in langs.where("id = 'x2'").select("id", "language").collect()} == {("x2", "en"), ("x2", "de")}
    empty = language.label_languages(df.limit(0), steps=1)
    assert empty.count() == 0


# ---- 2 scanned pages ---------------------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcde", min_size=1, max_size=7), min_size=1, max_size=40), st.text("abcde", min_size=1, max_size=7), st.integers(0, 3))
def test_automaton_retrieves_all(vocab, word, k):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(prev + (x != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    trie = ocr.Trie({w: 1 for w in vocab})
    got = {(w, d) for w, d, _ in ocr.LevenshteinAutomaton(word, k).within(trie)}
    assert got == {(w, distance(word, w)) for w in set(vocab) if distance(word, w) <= k}


@settings(deadline=None)
@given(st.lists(st.text(alphabet="mnrlicd", min_size=1, max_size=6), min_size=1, max_size=12), st.text(alphabet="mnrlicd1|", min_size=1, max_size=6), st.sampled_from([1, 2, 2.6]))
def test_reading_automaton_retrieves_all(vocab, word, limit):
    """All words of the trie, and all names of the trigram graph, whose weighted cost is within the limit, with that cost."""
    got = {w: c for c, w, _ in ocr.ReadingAutomaton(word, limit).within(ocr.Trie({w: 1 for w in vocab}))}
    want = {w: ocr.reading_cost(w, word) for w in vocab if ocr.reading_cost(w, word) <= limit + 1e-9}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
    grams = Counter(g for w in vocab for g in ocr.trigrams(w))
    names = {w for _, w, _ in ocr.ReadingAutomaton(word, limit).within(ocr.NameGraph(grams, 1))}
    assert {w for w in want if len(w) >= 3} <= names
    assert all(all(g in grams for g in ocr.trigrams(w)) and ocr.reading_cost(w, word) <= limit + 1e-9 for w in names)


def test_reading_cost():
    assert ocr.reading_cost("modern", "rnodern") == 1 and ocr.reading_cost("the", "tbe") == 1 and ocr.reading_cost("word", "wo¬rd") == 1
    assert ocr.reading_cost("same", "same") == 0 and ocr.reading_cost("abc", "axc") == 1.6


def test_page():
    words = Counter(re.findall(r"[a-z]+", prose(random.Random(1), 400).lower()))
    lex = ocr.Lexicon(dict(words), {("the", "garden"): 5}, {"water-wheel"}, Counter(g for n in NAMES for g in ocr.trigrams(n) for _ in range(5)), 40)
    text = "\n".join([
        "THE OLD GARDEN    12", "They searched tbe garden, and the kee-", "[13]", "The Old Garden", "", "per of the bridge opened the win dow in the",
        "evening. It is said that the rnarket was hidden", "Chapter 2: The River", "where the river had covered the lantern.", "The water-", "wheel was hidden.", "II", "The river",
    ])
    p = ocr.Page(text, "The Old Garden", lex)
    assert p.kinds() == [(1, "header"), (2, "hyphen"), (2, "misread"), (3, "page_number"), (4, "header"), (6, "misread"), (7, "misread")]
    out = p.repaired()
    assert "searched the garden, and the keeper of the bridge opened the window in the evening. It is said that the market was hidden" in out and "[13]" not in out
    for odd in ("", "\n", "-", "x" * 5000, "1\n2\n3", "a-\n", "¬¬¬ !!! ---"):
        ocr.Page(odd, None, lex).repaired()


def test_damaged_lines(spark):
    rng = random.Random(8)
    rows = [(f"c{i}", prose(rng, 12), "The Road") for i in range(40)]
    rows += [("d1", "The Road\n" + prose(rng, 3) + "\n[7]\n" + prose(rng, 2).replace("garden", "gardcn") + " The gardcn.", "The Road"), ("d2", None, None), ("d3", " ", "x"), ("c0", rows[0][1], "The Road")]
    df = frame(spark, rows, "id string, text string, title string").withColumn("kind", F.lit("clash"))
    got = {tuple(r) for r in ocr.damaged_lines(df).collect()}
    assert {("d1", 1, "header"), ("d1", 3, "page_number"), ("d1", 4, "misread")} == got
    assert ocr.damaged_lines(df.limit(0)).count() == 0
    fixed = {r["id"]: r["text"] for r in ocr.repair(df).collect()}
    assert "gardcn" not in fixed["d1"] and "[7]" not in fixed["d1"] and len(fixed) == 41


# ---- 3 splitting ---------------------------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n\té", max_size=400), st.integers(12, 90), st.integers(0, 5))
def test_split_round_trip(text, limit, overlap):
    pieces = split.split_text(text, limit, overlap)
    assert "".join(text[a + back : b] for a, b, back in pieces) == text
    assert all(b - a <= limit and 0 <= back <= overlap for a, b, back in pieces) and pieces[0][0] == 0 and pieces[0][2] == 0
    for (a, b, _), (c, _, back) in zip(pieces, pieces[1:]):
        assert c + back == b and c >= a


def test_split_finds_topic_change():
    a = " ".join(f"The bridge and the river met the {w}." for w in NOUNS[:5] * 3)
    b = " ".join(f"A kettle of copper warmed the {w}." for w in NOUNS[5:] * 3)
    cuts = split.cut_points(a + " " + b, len(a) + 120, 0)
    assert abs(cuts[1] - len(a)) < 60


def test_split_frame(spark):
    rows = [("a", "word " * 100), ("a", "word " * 100), ("b", "x" * 301), ("c", "short"), ("d", None), (None, "y" * 400)]
    df = frame(spark, rows, "k string, text string").withColumn("start", F.lit("clash"))
    got = split.split_oversized(df, "k", 100, 20)
    assert {r["k"] for r in got.collect()} == {"a", "b"} and got.where("length(text) > 100").count() == 0
    assert split.split_oversized(df, "k", 100, 20, keep_small=True).where("k = 'c' and n_pieces = 1").count() == 1
    assert split.split_oversized(df.limit(0), "k", 100, 20).count() == 0
    with pytest.raises(ValueError):
        split.split_text("x", 10, 5)


# ---- 4 near-duplicates ------------------------------------------------------------------------------------------------------------------


def brute_pairs(rows, size, threshold):
    sets = {}
    for k, t in rows:
        if t and t.strip():
            w = base.words(t)
            s = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
            if s:
                sets[k] = s
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


@pytest.mark.parametrize("size,threshold", [(3, 0.5), (5, 0.8)])
def test_near_duplicates(spark, size, threshold):
    rng = random.Random(11)
    rows = []
    for i in range(30):
        t = prose(rng, 8).split()
        rows.append((f"t{i:02d}", " ".join(t)))
        for j in range(rng.randrange(4)):
            v = list(t)
            for _ in range(rng.randrange(1, 12)):
                v[rng.randrange(len(v))] = rng.choice(NOUNS) + str(rng.randrange(99))
            rows.append((f"t{i:02d}v{j}", " ".join(v)))
    rows += [("same1", rows[0][1].upper()), ("same2", rows[0][1]), ("same2", rows[0][1]), ("n1", None), ("n2", "  "), ("short", "one two"), ("short2", "one two"), (None, rows[0][1])]
    df = frame(spark, rows, "id string, text string").withColumn("n", F.lit("clash"))
    found = neardup.NearDuplicates(df, "id", size, threshold)
    want = brute_pairs([r for r in dict(rows).items() if r[0]], size, threshold)
    assert {tuple(r) for r in found.pairs().collect()} == want and len(want) > 5
    links = {r["id"]: r["links"] for r in found.versions().collect()}
    assert links == {k: sum(k in p for p in want) for k in links}
    assert neardup.NearDuplicates(df.limit(0), "id", size, threshold).pairs().count() == 0


@pytest.mark.parametrize("threshold,low", [(0.5, 0.2), (0.8, 0.6)])
def test_sketch_decides(spark, threshold, low):
    """Sketches of pairs at the threshold pass, those of pairs well below do not: the exact check has little left to refuse."""
    rng = random.Random(5)
    rows, bands = neardup.banding(threshold)
    k = max(rows * bands, neardup.SAMPLES)
    texts, want = [], []
    for n, j in enumerate([threshold + 0.01] * 60 + [low] * 60):
        total = 400
        shared = [f"s{n}x{rng.random()}" for _ in range(round(total * j))]
        own = total - len(shared)
        for side, m in (("a", own // 2), ("b", own - own // 2)):
            texts.append((f"{n}{side}", " ".join([*shared, *[f"{side}{n}x{rng.random()}" for _ in range(m)]]).replace(".", "")))
        want.append(j >= threshold)
    signed = {r["id"]: np.array(r["sketch"], np.int64).view(np.uint64) for r in neardup.signatures(frame(spark, texts, "id string, text string"), "id", 1, rows, bands).collect()}
    differ = [sum(int(x).bit_count() for x in signed[f"{n}a"] ^ signed[f"{n}b"]) for n in range(120)]
    passed = [d <= neardup.most_differing(threshold, k) for d in differ]
    assert all(passed[:60]) and sum(passed[60:]) <= 3


def test_hot_buckets_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rows = [(c, [1, c]) for c in range(100)] + [(100 + c, [2, c]) for c in range(3)] + [(200, [999, 999])]
    got = {tuple(r) for r in neardup.candidate_pairs(frame(spark, rows, "class_hash long, bands array<long>")).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(range(100), 2)} | {(c, 100 + c) for c in range(3)} | set(itertools.combinations(range(100, 103), 2))


def test_short_texts_have_versions(spark):
    long = prose(random.Random(1))
    rows = [("a", "one two"), ("b", "One, two!"), ("c", "two one"), ("d", "..."), ("e", "..."), ("f", "!"), ("g", long), ("h", long), ("i", "one two three four"), ("n", None), ("m", " ")]
    df = frame(spark, rows, "id string, text string")
    got = neardup.NearDuplicates(df, short=True).versions().collect()
    groups = {}
    for r in got:
        groups.setdefault((r["class_id"], r["group_id"], r["links"]), set()).add(r["id"])
    assert sorted(map(sorted, groups.values())) == [["a", "b"], ["c"], ["d", "e"], ["f"], ["g", "h"], ["i"]] and all(k[2] == len(v) - 1 for k, v in groups.items())
    assert {tuple(r) for r in neardup.NearDuplicates(df).pairs().collect()} == {("g", "h")}


# ---- 5 tokens ---------------------------------------------------------------------------------------------------------------------------


def brute_tokens(text, pieces):
    n = 0
    for m in re.finditer(r"[^\W_]+|\S", text.lower()):
        w = m.group()
        if not w[0].isalnum():
            n += 1
            continue
        a, k = 0, 0
        while a < len(w):
            b = next((b for b in range(len(w), a, -1) if ("##" if a else "") + w[a:b] in pieces), None)
            if b is None:
                k = 1
                break
            k, a = k + 1, b
        n += k
    return n


PIECES = {"a", "ab", "c", "##b", "##c", "##bc", "##1", "1"}


@given(st.text(alphabet="abcd1 .,_\n", max_size=60))
def test_piece_counter(text):
    assert tokens.PieceCounter(PIECES).count(text) == brute_tokens(text, PIECES)


@given(st.lists(st.text(alphabet="abcd1 .,_\n\x00é", max_size=40), max_size=6))
def test_count_batch(texts):
    assert tokens.PieceCounter(PIECES).count_batch(texts).tolist() == [brute_tokens(t, PIECES) for t in texts]


def test_token_cube(spark):
    rows = [("1", "ab c", "X ", "t", "en"), ("2", "abc", "x", "T", "English"), ("3", "zz", None, None, "??"), ("3", "zz", None, None, "??"), ("4", None, "x", "t", "en")]
    df = frame(spark, rows, "id string, text string, source string, tradition string, language string").withColumn("tokens", F.lit("clash"))
    counted = tokens.count_tokens(tokens.documents_with_slices(df), "id", PIECES)
    cube = {(r["source"], r["tradition"], r["language"]): (r["documents"], r["tokens"]) for r in tokens.token_cube(counted).collect()}
    assert cube["x", "t", "en"] == (2, 4) and cube["(all)", "(all)", "(all)"] == (3, 5) and cube["unknown", "(all)", "(all)"] == (1, 1)
    assert tokens.token_cube(tokens.count_tokens(tokens.documents_with_slices(df.limit(0)), "id", PIECES)).where("documents > 0").count() == 0


def test_public_tokenizer(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    df = frame(spark, [("a", "The bridge and <|endoftext|>"), ("b", "")], "id string, text string")
    got = {r["id"]: r["n_tokens"] for r in tokens.count_public_tokens(df, "id", path).collect()}
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    assert got == {"a": len(t.encode("The bridge and <|endoftext|>", add_special_tokens=False)), "b": 0}


# ---- 6 clusters -----------------------------------------------------------------------------------------------------------------------------


def test_clusters(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for c, size in enumerate((10, 25, 14, 9, 60)):
        centre = rng.standard_normal(32)
        for i in range(size):
            v = centre + rng.standard_normal(32) * 0.12
            rows.append((f"c{c}_{i:02d}", [float(x) for x in v * rng.uniform(0.5, 2)]))
            want.setdefault(c, []).append(f"c{c}_{i:02d}")
    rows += [(f"z{i}", [float(x) for x in rng.standard_normal(32)]) for i in range(60)]
    same = [float(x) for x in rng.standard_normal(32)]
    rows += [(f"s{i:02d}", same) for i in range(12)]  # equal vectors
    rows += [("n1", None), ("n2", [0.0] * 32), ("n3", [1.0, 2.0]), rows[0], ("n4", [float("nan")] * 32), (None, same)]
    df = frame(spark, rows, "chunk_id string, vector array<float>").withColumn("cluster", F.lit("clash"))
    x = {k: np.array(v) / np.linalg.norm(v) for k, v in rows if k and v and len(v) == 32 and np.isfinite(v).all() and any(v)}
    groups = [g for g in want.values() if len(g) >= 10 and all(x[a] @ x[b] >= 0.85 for a in g for b in g)] + [[f"s{i:02d}" for i in range(12)]]
    assert len(groups) == 5
    found = mcl.VectorClusters(df)
    pairs = {tuple(r) for r in found.pairs().collect()}
    assert pairs == {p for g in groups for p in itertools.combinations(sorted(g), 2)}
    d = found.described().collect()
    assert sorted(r["size"] for r in d) == sorted(map(len, groups)) and all(len(r["typical"].split()) == 3 for r in d)
    assert mcl.VectorClusters(df.limit(0)).pairs().count() == 0


def test_large_clusters_follow_the_same_rule():
    rng = np.random.default_rng(8)
    x = 3.5 * np.eye(64)[0] + rng.standard_normal((20_100, 64)) * 0.125  # members are about 0.96 of the mean, pairs about 0.92
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ (x.mean(0) / np.linalg.norm(x.mean(0))) >= np.cos(np.arccos(0.85) / 2)
    assert near.mean() < 0.6  # half the angle of the mean would drop the others
    assert mcl._cliques(x, 0.85).mean() > 0.99
    some = np.concatenate([x[:300], rng.standard_normal((40, 64)) / 8])
    some /= np.linalg.norm(some, axis=1, keepdims=True)
    ok = some @ some.T >= 0.85 - 1e-6
    assert (mcl._degrees(some, 0.85, block=7) == ok.sum(1)).all()
    keep = mcl._cliques(some, 0.85)
    assert ok[np.ix_(keep, keep)].all() and not keep[300:].any()


def neighbours(rng, cross, size=40, dims=64):
    """Two clusters with pairs at about 0.93 inside; ``cross`` is about the cosine between them."""
    q = np.linalg.qr(rng.standard_normal((dims, 2)))[0].T
    turn = np.arccos(cross / 0.93)
    centres = [q[0], np.cos(turn) * q[0] + np.sin(turn) * q[1]]
    x = np.concatenate([c + rng.standard_normal((size, dims)) * np.sqrt((1 / 0.93 - 1) / dims) for c in centres])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("cross", [0.82, 0.835, 0.84])
def test_neighbouring_clusters_both_remain(cross):
    for seed in range(5):
        x = neighbours(np.random.default_rng(seed), cross)
        ok = x @ x.T >= 0.85 - 1e-6
        number = mcl._split(x, 0.85, 10)
        assert all(ok[np.ix_(number == n, number == n)].all() for n in set(number) - {-1})
        assert len(set(number) - {-1}) == 2 and (number >= 0).mean() > 0.95
    assert (mcl._split(x[:9], 0.85, 10) == -1).all() and (mcl._split(x[:2], 0.85, 10, np.array([5, 5])) == 0).all()


def test_links_are_exact(spark):
    x = neighbours(np.random.default_rng(1), 0.835).astype(np.float32)
    df = frame(spark, [(i, [float(y) for y in v]) for i, v in enumerate(x)], "node long, v array<float>")
    got = [(r["src"], r["dst"]) for r in mcl.similar_pairs(df, 0.85).collect()]
    assert got and all(x[a].astype(float) @ x[b].astype(float) >= 0.85 - 1e-6 for a, b in got)
    found = mcl.VectorClusters(df.withColumnRenamed("node", "k"), "k", "v").checked().collect()
    assert len({r["cluster"] for r in found}) == 2 and len(found) > 70


def test_hot_buckets_of_vectors_lose_no_pair(spark):
    """Cells of blocks find the links that whole buckets find."""
    x = neighbours(np.random.default_rng(2), 0.9, size=30).astype(np.float32)
    df = frame(spark, [(i, [float(y) for y in v]) for i, v in enumerate(x)], "node long, v array<float>")
    whole, cells = ({(r["src"], r["dst"]) for r in mcl.similar_pairs(df, 0.85, strongest=100, most=m).collect()} for m in (4096, 9))
    assert whole == cells and len(whole) > 500


@pytest.mark.parametrize("n", [500, 20_000])
def test_index_recall(n):
    """Of pairs at the very threshold, those that share a code."""
    rng = np.random.default_rng(9)
    d = mcl.Directions(n, 64, 0.85)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal(x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y = 0.85 * x + np.sqrt(1 - 0.85**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    assert (d.codes(x.astype(np.float32)) == d.codes(y.astype(np.float32))).any(1).mean() > 0.93


def test_dense_parts_of_a_cluster_stay_together(spark):
    rng = np.random.default_rng(12)
    q = np.linalg.qr(rng.standard_normal((64, 4)))[0].T
    centres = [np.sqrt(0.91) * q[0] + np.sqrt(0.09) * c for c in q[1:]]  # 0.91 between the centres of the parts
    x = np.concatenate([c + rng.standard_normal((200, 64)) * np.sqrt(0.0125 / 64) for c in centres])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert (x @ x.T).min() > 0.85
    noise = rng.standard_normal((400, 64))
    rows = [(f"k{i:04d}", [float(y) for y in v]) for i, v in enumerate(np.concatenate([x, noise]))]
    found = mcl.VectorClusters(frame(spark, rows, "chunk_id string, vector array<float>")).checked().collect()
    assert {r["chunk_id"] for r in found} == {f"k{i:04d}" for i in range(600)} and {(r["cluster"], r["size"]) for r in found} == {(found[0]["cluster"], 600)}


def test_links_beside_the_strongest():
    rng = np.random.default_rng(4)
    x = np.concatenate([[1, 0.3 * (c - 1), *[0] * 6] + rng.standard_normal((70, 8)) * 0.01 for c in range(2)])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    for block in (2048, 50):
        i, j, s, strong = mcl.strongest_links(x, 0.85, 40, block)
        assert np.allclose(s, (x[i] * x[j]).sum(1), atol=1e-5) and (i != j).all()
        assert not ((i < 70) != (j < 70))[strong].any() and ((i < 70) != (j < 70))[~strong].any()


def test_block_and_sparse_agree(spark):
    rng = random.Random(3)
    edges = {}
    for g in range(3):
        for a, b in itertools.combinations(range(g * 10, g * 10 + 10), 2):
            if rng.random() < 0.9:
                edges[a, b] = 0.9
    edges[9, 10] = 0.86  # a weak bridge
    e = frame(spark, [(a, b, w) for (a, b), w in edges.items()], "src long, dst long, w double")

    def parts(df):
        out = {}
        for r in df.collect():
            out.setdefault(r["cluster"], set()).add(r["node"])
        return {frozenset(v) for v in out.values()}

    flows = [{r["node"]: (r["cluster"], round(r["flow"], 4)) for r in mcl.markov_clusters(e, block=b).collect()} for b in (1500, 5)]
    assert flows[0] == flows[1]
    want = {frozenset(range(g * 10, g * 10 + 10)) for g in range(3)}
    assert parts(mcl.markov_clusters(e)) == want and parts(mcl.markov_clusters(e, block=5)) == want


# ---- 7 quality ----------------------------------------------------------------------------------------------------------------------------------


def test_quality(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randrange(3, 9)))
    rows = [(f"p{i}", prose(rng, rng.randrange(3, 9)), "prose") for i in range(60)]
    for i in range(6):
        rows += [
            (f"l{i}", "\n".join(f"{n}. {rng.choice(NAMES)} of the {rng.choice(NOUNS)}" for n in range(1, 15)), "list"),
            (f"b{i}", "\n".join(f"* {rng.choice(NAMES).lower()} {rng.choice(NOUNS)}" for _ in range(12)), "list"),
            (f"t{i}", "\n".join(f"{rng.choice(NOUNS)} | {rng.random() * 90:.2f} | {rng.randrange(9999)} | {rng.choice(NAMES)}" for _ in range(12)), "table"),
            (f"s{i}", "\n".join(f"{rng.choice(NOUNS)}\t{rng.randrange(999)}\t{rng.randrange(9999)}" for _ in range(12)), "table"),
            (f"j{i}", " ".join(word() for _ in range(50)), "junk"),
        ]
    rows.append(("mix", prose(rng, 10) + "\n\n" + "* narrow bridge\n* old kettle", "prose"))
    df = frame(spark, [*rows, ("n1", None, ""), ("n2", " \n ", ""), rows[0], ("one", "x", "")], "id string, text string, kind string")
    got = {r["id"]: r for r in quality.text_quality(df.withColumn("chars", F.lit("clash"))).collect()}
    assert len(got) == len(rows) + 1 and "n1" not in got and "n2" not in got
    wrong = [(i, k, got[i]["kind"]) for i, _, k in rows if got[i]["kind"] != k]
    assert not wrong, wrong
    assert got["p0"]["n_words"] == len(base.words(rows[0][1])) and 0 <= got["p0"]["common_share"] <= 1
    assert quality.text_quality(df.limit(0)).count() == 0


def test_mixture_steps():
    """The likelihood never falls, sums of parts add up to those of the whole, kinds are those of the posterior, and size does not matter."""
    rng = np.random.default_rng(3)
    d = len(quality.FEATURES)
    examples = rng.random((len(quality.EXAMPLES), d))
    raw = examples[rng.integers(len(examples), size=3000)] + 0.03 * rng.standard_normal((3000, d))

    def fit(raw):
        m = first = quality.start_mixture(raw.mean(0), raw.std(0), examples)
        logs = []
        for _ in range(12):
            acc = m.sums(raw)
            assert np.allclose(acc, m.sums(raw[:700]) + m.sums(raw[700:], step=99))
            logs.append(acc[-1])
            m = quality.next_mixture(m, first, acc, 2 + 0.002 * len(raw))
        return m, logs

    m, logs = fit(raw)
    assert all(b >= a - 0.02 * abs(a) for a, b in zip(logs, logs[1:]))
    p = m.posterior(m.expand(raw))[0]
    assert np.allclose(p.sum(1), 1) and np.allclose(m.kinds(raw).sum(1), 1)
    by_hand = np.array([sum(p[0][i] for i, k in enumerate(m.kind) if k == kind) for kind in quality.KINDS])
    assert np.allclose(m.kinds(raw)[0], by_hand)
    twice, _ = fit(np.concatenate([raw] * 4))
    assert (twice.kinds(raw).argmax(1) == m.kinds(raw).argmax(1)).mean() > 0.99


# ---- 8 packing ------------------------------------------------------------------------------------------------------------------------------------


@given(st.text(alphabet="abc ._1", max_size=120), st.integers(1, 12))
def test_cut_sizes(text, capacity):
    c = tokens.PieceCounter(PIECES)
    total, cuts = packing.cut_sizes(text, c, capacity)
    assert total == brute_tokens(text, PIECES) == sum(n for *_, n in cuts) and all(n <= capacity for *_, n in cuts)
    if total > capacity:
        assert len(cuts) > 1


def test_pack(spark):
    rng = random.Random(7)
    pieces = set(re.findall(r"[a-z]+", prose(rng, 300).lower()))
    rows = [(i, prose(rng, rng.randrange(2, 30))) for i in range(300)] + [(900, prose(rng, 200)), (901, None), (902, " "), (0, "x")]
    df = frame(spark, rows, "doc_id long, text string").withColumn("tokens", F.lit("clash")).where("doc_id <> 0 or text <> 'x'")
    out = packing.pack_documents(df, pieces, capacity=512, shard_rows=120).toPandas()
    sizes = {i: brute_tokens(t, pieces) for i, t in rows[:301]}
    assert out.groupby("doc_id")["tokens"].sum().to_dict() == sizes
    load = out.groupby("container")["tokens"].sum()
    assert load.max() <= 512 and load.mean() > 0.93 * 512
    assert set(out[out["n_pieces"] > 1]["doc_id"]) == {i for i, n in sizes.items() if n > 512}
    assert packing.pack_documents(df.limit(0), pieces).count() == 0


def test_packing_prefers_like_items():
    bags = [["salt", "fire"] * 5, ["salt", "fire"] * 5, ["rain", "wind"] * 5, ["rain", "wind"] * 5, ["snow"] * 10, ["mist"] * 10]
    terms, counts, _ = zip(*[packing.bag(" ".join(b)) for b in bags])
    box = packing.pack_items(np.array([10] * 6), list(terms), list(counts), 20)
    assert box[0] == box[1] and box[2] == box[3]


@given(st.lists(st.lists(st.integers(0, 12), max_size=20), min_size=1, max_size=8))
def test_bm25_index(bags):
    """Scores by postings are those of the formula, item by item."""
    held = [Counter(b) for b in bags]
    terms, counts = [np.array(sorted(h), np.int32) for h in held], [np.array([h[t] for t in sorted(h)], np.int32) for h in held]
    index, n, mean = packing.BM25Index(terms, counts), len(bags), max(1.0, sum(map(len, bags)) / len(bags))
    for seed in range(n):
        want = np.zeros(n)
        for t in held[seed]:
            df = sum(t in h for h in held)
            if 2 <= df <= max(2, n // 2):
                for i, h in enumerate(held):
                    if t in h:
                        want[i] += np.log(1 + (n - df + 0.5) / (df + 0.5)) * h[t] * 2.2 / (h[t] + 1.2 * (0.25 + 0.75 * len(bags[i]) / mean))
        assert np.allclose(index.scores(terms[seed]), want)


def test_like_items_share_shards(spark):
    """Texts of two kinds come to different shards of a bounded size, also where one kind holds most rows."""
    rng = random.Random(2)
    word = {k: [f"{k}{c}{d}" for c in "abcdefg" for d in "hijk"] for k in ("salt", "rain")}
    rows = [(i, " ".join(rng.choices(word["salt" if i % 4 else "rain"], k=30))) for i in range(800)]
    out = packing.pack_documents(frame(spark, rows, "doc_id long, text string"), {"salt"}, shard_rows=100, cells=4).toPandas()
    kinds = out.assign(kind=out["doc_id"] % 4 > 0).groupby("shard")["kind"].mean()
    assert ((kinds < 0.05) | (kinds > 0.95)).mean() >= 0.8 and out.groupby("shard").size().max() <= 160


def test_places_are_fitted_to_all_items(spark):
    """Word counts and centres are those of every item, whatever the partitions; a sample of 5,000 had other ones."""
    rng = random.Random(4)
    word = {k: [f"{k}{c}{d}" for c in "abcdefg" for d in "hijk"] for k in ("salt", "rain", "wind")}
    texts = [" ".join(rng.choices(word[rng.choice(list(word))], k=8)) for _ in range(9000)]
    held = [packing.bag(t)[0].tobytes() for t in texts]
    items = frame(spark, [(i, 0, bytearray(t)) for i, t in enumerate(held)], "doc_id long, piece_no int, terms binary")
    one, seven = (packing.fit_places(items.repartition(k, "doc_id"), "doc_id", 5) for k in (1, 7))
    df = Counter(w for t in texts for w in set(t.split()))
    want = {int(packing._NUMBERS[w]): np.log(1 + (9000 - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    got = dict(zip(one.terms.tolist(), one.rarity.tolist()))
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)
    assert np.allclose(one.centres, seven.centres, atol=1e-6) and len(one.centres) == 5
    plain = packing.fit_places(items, "doc_id", 5, rounds=0)
    for _ in range(12):
        unit, own = plain.cells(plain.vectors(held))
        total = np.array([unit[own == c].sum(0) for c in range(5)])
        plain.centres = (total / np.linalg.norm(total, axis=1, keepdims=True)).astype(np.float32)
    assert np.abs(one.centres @ plain.centres.T).max(1).min() > 0.9999


def test_pack_without_words(spark):
    """Texts that hold no word of letters have no vector; they are packed all the same."""
    out = packing.pack_documents(frame(spark, [(i, "12 34 5") for i in range(20)], "doc_id long, text string"), {"salt"}, capacity=64).toPandas()
    assert sorted(out["doc_id"]) == list(range(20)) and out.groupby("container")["tokens"].sum().max() <= 64


# ---- 9 leakage --------------------------------------------------------------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 9), max_size=80), st.integers(1, 9))
def test_winnow_guarantee(values, window):
    h = np.array(values, dtype=np.uint64)
    at = leakage.winnow(h, window).tolist()
    for s in range(max(1, len(h) - window + 1) if len(h) else 0):
        part = h[s : s + window]
        last = s + len(part) - 1 - int(np.argmin(part[::-1]))
        assert last in at


def test_leaks(spark):
    rng = random.Random(13)
    items = [(i, " ".join(rng.choice(NOUNS) + str(rng.randrange(60)) for _ in range(rng.randrange(8, 60)))) for i in range(25)]
    docs = []
    for i in range(80):
        w = prose(rng, 4).split()
        if i % 2:
            t = rng.choice(items)[1].split()
            n = rng.randrange(8, 20)
            a = rng.randrange(max(1, len(t) - n))
            w[5:5] = t[a : a + n]
        docs.append((i, " ".join(w).upper() if i % 3 else ", ".join(w)))
    docs += [(500, None), (501, ""), (502, items[3][1]), docs[1]]
    d, e = frame(spark, docs, "doc_id long, text string").withColumn("h", F.lit("clash")), frame(spark, [*items, (99, None), items[0]], "item_id long, text string")
    want = set()
    for i, t in docs:
        w = base.words(t or "")
        grams = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        for j, s in items:
            v = base.words(s)
            if any(tuple(v[k : k + 12]) in grams for k in range(len(v) - 11)):
                want.add((i, j))
    got = leakage.leaked_items(d, e)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) > 10 and got.where("words < 12").count() == 0
    assert leakage.leaked_items(d.limit(0), e).count() == 0 and leakage.leaked_items(d, e.limit(0)).count() == 0


@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), max_size=40))
def test_longest_run(a, b):
    best = max((n for n in range(3, 41) for i in range(len(a) - n + 1) if any(a[i : i + n] == b[j : j + n] for j in range(len(b) - n + 1))), default=0)
    assert leakage.longest_common_run(a, b, 3) == best


# ---- 10 subjects ---------------------------------------------------------------------------------------------------------------------------------------

FIELDS = {"mining": "ore shaft smelt copper tunnel pick vein".split(), "sailing": "mast rudder anchor tide deck hull rigging".split(), "baking": "dough oven yeast crust flour knead loaf".split()}


def paragraph(rng, field):
    out = []
    for _ in range(3):
        w = rng.sample(FIELDS[field], 2) if field else rng.sample(NOUNS, 2)
        a = rng.choice(NOUNS)
        out.append(f"They kept the {w[0]} near the {a} and asked about the {w[1]} with {rng.choice(NAMES)}.")
    return " ".join(out)


def test_subjects(spark):
    rng = random.Random(21)
    docs, truth, labels = [], set(), []
    for i in range(240):
        kinds = [rng.choice([*FIELDS, None])] * rng.randrange(2, 5)
        if i % 4 == 0:
            kinds += [rng.choice(list(FIELDS))] * 2
        docs.append((i, "\n \n".join(paragraph(rng, k) for k in kinds), None if i % 5 else "A Book", None, f"s{i % 3}"))
        n = Counter(kinds)
        truth |= {(i, k) for k, c in n.items() if k and c * 4 >= len(kinds)}
        if i % 4 and kinds[0] and i < 120:
            labels.append((i, kinds[0], "r"))
    labels += [labels[0], (labels[1][0], "baking", "r"), (9999, "mining", "r"), (3, None, "r")]
    docs += [(800, None, None, None, None), (801, "  ", "x", "y", "z")]
    d = frame(spark, docs, "doc_id long, text string, title string, tradition string, source string").withColumn("subject", F.lit("clash"))
    lab, sub = frame(spark, labels, "doc_id long, subject string, reader string"), frame(spark, [(k,) for k in FIELDS], "subject string")
    got = {(r["doc_id"], r["subject"]) for r in subjects.document_subjects(d, lab, sub).collect()}
    assert len(got & truth) / len(truth) > 0.97 and len(got & truth) / len(got) > 0.97
    assert subjects.document_subjects(d.limit(0), lab, sub).count() == 0 and subjects.document_subjects(d, lab.limit(0), sub).count() == 0


@given(st.lists(st.tuples(st.integers(1, 3), st.floats(0, 1)), min_size=1, max_size=4), st.integers(1, 8))
def test_at_least(events, need):
    qs = [q for n, q in events for _ in range(n)]
    want = sum(np.prod([q if x else 1 - q for x, q in zip(xs, qs)]) for xs in itertools.product([0, 1], repeat=len(qs)) if sum(xs) >= need)
    assert abs(subjects.at_least([n for n, _ in events], [q for _, q in events], need) - want) < 1e-6


def test_likely_subjects():
    post = np.array([[0.9, 0.05, 0.05], [0.1, 0.2, 0.7], [0.0, 0.55, 0.45]])
    for ns in ([1, 3, 0], [2, 5, 4], [1, 1, 2], [400, 900, 300]):
        found = {k for k, _ in subjects.likely_subjects(ns, post, 0.25)}
        assert found == {k for k in (0, 1) if subjects.at_least(ns, post[:, k].tolist(), -(-sum(ns) // 4)) >= 0.5}
    assert subjects.likely_subjects([3], np.array([[0.2, 0.8]]), 0.25) == []


def test_label_model_learns_accuracy():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 5, 4000)  # 4 subjects and none
    acc = [0.95, 0.8, 0.5]
    v = np.stack([np.where(rng.random(4000) < a, y, rng.integers(0, 5, 4000)) for a in acc], 1)
    v[rng.random(v.shape) < 0.3] = -1
    pats, counts = np.unique(v, axis=0, return_counts=True)
    post, learned = subjects.fit_votes(pats, counts.astype(float), 4)
    assert learned[0, 0] > learned[1, 0] > learned[2, 0]
    where = {tuple(p): int(q.argmax()) for p, q in zip(pats, post)}
    told = np.array([where[tuple(x)] for x in v])
    spoken = (v[:, 0] >= 0) | (v[:, 1] >= 0)
    assert (told[spoken] == y[spoken]).mean() > 0.85
