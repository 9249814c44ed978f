"""Sinks and what reads them back: sidecar pairs, manifests, arrays, pages, resumed embedding, model tokenizers."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chunking, embedding
from corpusloom.sources import files, sinks


def test_sidecars_round_trip(spark, tmp_path):
    rows = [("a/1", "Some text\nof two lines", "T", None), ("b", "x", None, "A"), ("c", None, None, "A"), (None, "lost", "x", "y")]
    df = sinks.with_metadata(spark.createDataFrame(rows, "id string, text string, title string, author string"))
    assert sinks.write_sidecars(df, str(tmp_path / "out")) == 2
    got = {r["id"]: (r["text"], r["title"], r["author"], r["tradition"]) for r in files.with_sidecars(spark, str(tmp_path / "out")).collect()}
    assert got["a/1"] == ("Some text\nof two lines", "T", "unknown", "unknown") and got["b"] == ("x", "", "A", "unknown") and len(got) == 2
    assert sinks.write_sidecars(df.limit(0), str(tmp_path / "none")) == 0


def test_metadata_from_manifest(spark):
    records = spark.createDataFrame([("a", None), ("b", "B")], "id string, title string")
    known = spark.createDataFrame([("a", "From manifest", "html"), ("b", "Other", None)], "id string, title string, file_type string")
    got = {r["id"]: (r["title"], r["file_type"], r["source"]) for r in sinks.with_metadata(records, known).collect()}
    assert got == {"a": ("From manifest", "html", ""), "b": ("B", "", "")}


def test_manifest_round_trip(spark, tmp_path):
    state = spark.createDataFrame([("x", "downloaded", 'A "title"', 3), ("y", "failed", None, None), (None, "failed", None, None)], "item_id string, status string, title string, chapters int")
    path = sinks.write_manifest(state, str(tmp_path / "m" / "manifest.json"))
    assert set(json.loads(sinks.read_file(path))["items"]) == {"x", "y"}
    got = {r["item_id"]: (r["status"], r["title"], r["chapters"]) for r in files.read_manifest(spark, path).collect()}
    assert got == {"x": ("downloaded", 'A "title"', 3), "y": ("failed", None, None)}


def test_errors_append(spark, tmp_path):
    e = spark.createDataFrame([("2026-01-01", "process", "s", "i", "ValueError", "line 1\nline 2")], files.ERROR)
    for n in (1, 2):
        files.append_errors(e, str(tmp_path / "log"))
        assert spark.read.schema(files.ERROR).json(str(tmp_path / "log")).count() == n


def test_arrays_and_pages(spark, tmp_path):
    x = np.arange(24, dtype=np.float32).reshape(8, 3)
    path = sinks.write_array(x, str(tmp_path / "v.npy"))
    back = sinks.load_matrix(spark, path, parts=3).orderBy("row").collect()
    assert [r["row"] for r in back] == list(range(8)) and np.allclose([r["vector"] for r in back], x)
    assert sinks.load_matrix(spark, path, ids=list("abcdefgh")).where("id = 'c'").first()["vector"] == [6.0, 7.0, 8.0]
    with pytest.raises(ValueError):
        sinks.load_matrix(spark, sinks.write_array(np.arange(3), str(tmp_path / "one.npy")))
    m = spark.createDataFrame([("p", "p", 1.0), ("p", "q", 0.25), ("q", "p", 0.25), ("q", "q", 1.0)], "a string, b string, sim double")
    assert sinks.write_matrix(m, str(tmp_path / "m.npy")) == ["p", "q"]
    assert np.load(tmp_path / "m.npy").tolist() == [[1.0, 0.25], [0.25, 1.0]]
    page = sinks.read_file(sinks.heatmap_page(m, str(tmp_path / "h.html"), value="sim", title="a <b>")).decode()
    assert page.count("<td") == 4 and "a &lt;b&gt;" in page
    points = spark.createDataFrame([(0.0, 1.0, "g", "<t>"), (2.0, 3.0, None, "u")], "x double, y double, tradition string, text string")
    page = sinks.read_file(sinks.scatter_page(points, str(tmp_path / "s.html"), "tradition")).decode()
    assert page.count("<circle") == 2 and "&lt;t&gt;" in page
    assert "<circle" not in sinks.read_file(sinks.scatter_page(points.limit(0), str(tmp_path / "e.html"), "tradition")).decode()


def test_embedding_resumes(spark, tmp_path):
    """Parts that are there are not made again; a part that was broken off is."""
    df = spark.createDataFrame([(f"c{i}", f"word{i % 7} text") for i in range(60)], "chunk_id string, text string")
    out = str(tmp_path / "vectors")
    assert sorted(embedding.embed_in_parts(df, out, "chunk_id", parts=4)) == [0, 1, 2, 3]
    whole = {r["chunk_id"]: r["vector"] for r in spark.read.parquet(out).collect()}
    assert len(whole) == 60
    (tmp_path / "vectors" / "part=2" / "_SUCCESS").unlink()
    assert embedding.embed_in_parts(df, out, "chunk_id", parts=4) == [2]
    assert {r["chunk_id"]: r["vector"] for r in spark.read.parquet(out).collect()} == whole
    assert embedding.embed_in_parts(df, out, "chunk_id", parts=4) == []
    assert len(embedding.embed_in_parts(df, out, "chunk_id", parts=4, force=True)) == 4


def test_model_tokenizer_chunks(spark, tmp_path):
    """Windows over the tokens of a tokenizer file; pieces are decoded by the same file."""
    tokenizers = pytest.importorskip("tokenizers")
    words = [f"w{i}" for i in range(40)]
    tok = tokenizers.Tokenizer(tokenizers.models.WordLevel({w: i for i, w in enumerate([*words, "[UNK]"])}, unk_token="[UNK]"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tok.save(str(tmp_path / "t.json"))
    encode, decode = chunking.model_tokenizer(str(tmp_path / "t.json"))
    df = spark.createDataFrame([("d", " ".join(words)), ("e", "w1")], "id string, text string")
    rows = chunking.chunk(df, "id", chunking.Profile("p", 16, 4), tokenize=encode, decode=decode).orderBy("chunk_id").collect()
    assert [r["text"] for r in rows] == [" ".join(words[0:16]), " ".join(words[12:28]), " ".join(words[24:40]), "w1"]
    assert df.select(F.size(encode(F.col("text"))).alias("n")).collect()[0]["n"] == 40


def test_crawls_keep_what_they_fetch(spark, tmp_path):
    from corpusloom.sources import crawl

    web = {
        "https://h.example/alc/": '<a href="book/index.htm">B</a>',
        "https://h.example/alc/book/index.htm": '<a href="c1.htm">1</a><a href="c2.htm">2</a>',
        "https://h.example/alc/book/c1.htm": "<p>one</p>",
    }
    none = spark.createDataFrame([], "source string, item_id string, status string")
    assert crawl.TraditionCrawl("https://h.example").paths["alchemy"] == "/alc/"
    rows = crawl.TraditionCrawl("https://h.example", traditions=["alchemy"], delay=0, store=str(tmp_path / "pages")).run(spark, web.get, none).collect()
    assert [(r["chapters"], r["chapters_ok"], r["status"]) for r in rows] == [(2, 1, "downloaded")]
    assert {r["url"]: r["html"] for r in spark.read.parquet(str(tmp_path / "pages")).collect()}["https://h.example/alc/book/c1.htm"] == "<p>one</p>"

    def download(item, name):
        if item == "b":
            raise OSError("gone")
        return f"{item} {name}".encode()

    a = crawl.ArchiveCrawl(["x"], lambda q: [{"identifier": i} for i in ("a", "b")], lambda i: [{"name": "t.txt"}, {"name": "p.png"}], download=download, store=str(tmp_path / "files"))
    got = {r["item_id"]: (r["status"], r["files"]) for r in a.run(spark, web.get, none).collect()}
    assert got == {"a": ("downloaded", ["t.txt"]), "b": ("failed", [])} and sinks.read_file(str(tmp_path / "files/a/t.txt")) == b"a t.txt"


def test_commands(spark, tmp_path, monkeypatch):
    """From raw files to a chart by the commands alone."""
    from corpusloom import cli

    raw, at = tmp_path / "raw" / "src", lambda n: str(tmp_path / n)
    raw.mkdir(parents=True)
    body = "The keeper opened the gate of the garden, and the miller was at the bridge that evening. "
    for i in range(6):
        (raw / f"book{i}.txt").write_text("\n".join(f"{body} The {w} was old, number {i * 7 + k}." for k, w in enumerate(["lamp", "road", "wall", "loaf"])))
    (raw / "short.txt").write_text("too short")
    run = lambda *x: cli.main([str(y) for y in x])
    assert run("process", tmp_path / "raw", at("records"), "--sidecars", at("pairs"), "--summary", at("s.json"), "--errors", at("errors")) == 0
    assert json.loads(sinks.read_file(at("s.json"))) == {"processed": 6, "too_short": 1} and spark.read.json(at("errors")).count() == 1
    assert files.with_sidecars(spark, at("pairs")).count() == 6
    assert run("export", at("records"), at("corpus"), "--summary", at("c.json")) == 0 and json.loads(sinks.read_file(at("c.json")))["languages"] == {"en": 7}
    assert run("chunk", at("corpus"), at("chunks"), "--profile", "search") == 0 and spark.read.parquet(at("chunks")).count() == 7
    assert run("embed", at("chunks"), at("vectors"), "--parts", 2) == 0 and json.loads(sinks.read_file(at("vectors/_model.json")))["dimensions"] == 64
    assert run("search", at("vectors"), "old road", "--top-k", 2) == 0
    assert run("similarity", at("vectors"), at("sim"), "--array", at("m.npy"), "--html", at("m.html")) == 0 and np.load(at("m.npy")).shape == (1, 1)
    assert run("visualize", at("vectors"), at("points"), "--html", at("v.html")) == 0 and sinks.read_file(at("v.html")).decode().count("<circle") == 7
    assert run("cluster", at("vectors"), at("clusters"), "--min-cluster-size", 3, "--dimensions", 8) == 0 and spark.read.parquet(at("clusters")).count() == 7
    assert run("pick-best", at("corpus"), at("best")) == 0 and spark.read.parquet(at("best")).count() == 0
    (tmp_path / "c.json").write_text(json.dumps({"sources": {"trad": {"kind": "tradition", "base": "https://h.example", "traditions": ["alchemy"], "delay": 0}}}))
    monkeypatch.setattr(cli, "named", lambda path: {"https://h.example/alc/": '<a href="b/index.htm">B</a>', "https://h.example/alc/b/index.htm": "x"}.get)
    for _ in range(2):  # what is there is not fetched again
        assert run("scrape", at("c.json"), at("state"), "--fetch", "x:y") == 0 and spark.read.parquet(at("state")).count() == 1
