import io
import json
import urllib.error

from pyspark.sql import functions as F

from corpusloom.plans.pipeline import extract
from corpusloom.sources import crawl, files, html
from corpusloom.streaming import incremental

PAGE = """<html><head><title>t</title></head><body><nav>Home</nav><div class="Main-Header big">menu</div>
<h1>First <b>head</b></h1><p>One &amp; two<br>three <i>four</i></p><h2> </h2><h3>Third</h3><script>x()</script>
<p>unclosed <div class="x">inner</div><footer>end</footer></body></html>"""


def test_page_text():
    text, heads = html.page_text(PAGE)
    assert heads == ["Firsthead", "Third"]
    assert text.split("\n") == ["First", "head", "One & two", "three", "four", "Third", "unclosed", "inner"]
    assert html.page_text("<h1>x</h1>no body") == ("", [])
    assert html.page_text("") == ("", [])
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert html.page_text(f"<body>{deep}</body>")[0] == "x"


def test_links():
    page = '<a href="alc/index.htm">a</a><a href="/alc/b/index.html">b</a><a href="http://else.where/index.htm">c</a><a href="x.htm">d</a><a>e</a>'
    assert html.index_links(page, "https://h.example/") == ["https://h.example/alc/index.htm", "https://h.example/alc/b/index.html"]
    assert html.chapter_links(page, "https://h.example/") == ["https://h.example/x.htm"]
    results = '<ul><li class="booklink"><a class="link" href="/ebooks/12"><span class="title">T</span><span class="subtitle">A B</span></a></li><li class="booklink"><a class="link" href="/ebooks/7">U</a></li><li class="booklink"><a>none</a></li></ul>'
    assert html.search_results(results) == [("12", "TA B", "A B"), ("7", "U", "unknown")]


def test_columns(spark):
    df = spark.createDataFrame([("t", "https://h.example/a/b/c.htm", PAGE), ("t", None, None)], "tradition string, url string, html string")
    r = df.select(html.url_to_id(F.col("tradition"), F.col("url")).alias("i"), html.html_page("html").alias("p"), html.book_links_or_self(F.col("html"), F.col("url")).alias("l"), html.headings_fast(F.col("html")).alias("h")).collect()
    assert r[0]["i"] == "t/a_b_c.htm" and r[0]["p"]["chapters"] == ["Firsthead", "Third"] and r[0]["l"] == ["https://h.example/a/b/c.htm"] and r[0]["h"] == ["Third"]
    assert r[1]["i"] is None and r[1]["p"]["text"] is None


def test_files(spark, tmp_path):
    raw = tmp_path / "raw" / "src" / "sub"
    raw.mkdir(parents=True)
    (raw / "a.TXT").write_bytes(b"A\xffB")
    (raw / "b.html").write_text("<body><h1>H</h1>text</body>")
    (raw / "c.pdf").write_bytes(b"%PDF")
    (raw / "d.png").write_bytes(b"x")
    (raw.parent / "manifest.json").write_text(json.dumps({"items": {"a": {"status": "downloaded"}}}))
    f = files.raw_files(spark, str(tmp_path / "raw"))
    assert {(r["id"], r["ext"], r["rel"]) for r in f.collect()} == {("src_sub_a", ".txt", "sub/a.TXT"), ("src_sub_b", ".html", "sub/b.html"), ("src_sub_c", ".pdf", "sub/c.pdf")}
    assert files.raw_files(spark, str(tmp_path / "raw"), skip_pdf=True).count() == 2
    pages = files.pdf_pages(f.where("ext = '.pdf'"), lambda b: ["one", "two"])
    got = {r["id"]: (r["text"], r["chapters"]) for r in extract(f, pages).collect()}
    assert got == {"src_sub_a": ("A�B", []), "src_sub_b": ("H\ntext", ["H"]), "src_sub_c": ("one\n\ntwo", [])}
    assert files.ocr_pages(f.where("ext = '.pdf'"), lambda b: [["l1", "l2"], ["l3"]]).first()["text"] == "l1 l2\n\nl3"
    assert files.read_manifest(spark, str(raw.parent / "manifest.json")).first()["status"] == "downloaded"
    assert files.read_manifest(spark, str(tmp_path / "none.json")).count() == 0
    side = tmp_path / "done"
    side.mkdir()
    (side / "x.txt").write_text("body")
    (side / "x.json").write_text(json.dumps({"id": "x", "title": "T"}))
    (side / "y.txt").write_text("unpaired")
    assert [(r["id"], r["text"], r["title"]) for r in files.with_sidecars(spark, str(side)).collect()] == [("x", "body", "T")]


def test_fetcher_retries():
    calls, slept = [], []

    def opener(req, timeout):
        calls.append(req.full_url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(req.full_url, 503, "busy", {}, None)
        return io.BytesIO(b"ok")

    assert crawl.http_fetcher(opener=opener, sleep=slept.append)("http://h.example/") == "ok" and slept == [1.0, 2.0]

    def missing(req, timeout):
        raise urllib.error.HTTPError(req.full_url, 404, "no", {}, None)

    assert crawl.http_fetcher(opener=missing, sleep=slept.append)("http://h.example/") is None


def test_crawls(spark):
    site = {
        "https://h.example/alc/": '<a href="https://h.example/alc/b1/index.htm">1</a><a href="https://h.example/alc/b2/index.htm">2</a>',
        "https://h.example/alc/b1/index.htm": '<a href="c1.htm">c</a><a href="c2.htm">c</a>',
        "https://h.example/alc/b1/c1.htm": "<body>x</body>",
        "https://h.example/alc/b2/index.htm": "<body>only page</body>",
        "https://g.example/s?q=salt": '<li class="booklink"><a class="link" href="/ebooks/12">T</a></li><li class="booklink"><a class="link" href="/ebooks/13">U</a></li>',
        "https://g.example/12.txt": "the text",
    }
    none = spark.createDataFrame([], "source string, item_id string, status string")
    t = crawl.TraditionCrawl("https://h.example/", {"alchemy": "alc/"}, ["alchemy", "unknown-one"], delay=0)
    got = {r["item_id"]: (r["status"], r["chapters"], r["chapters_ok"]) for r in t.run(spark, site.get, none).collect()}
    assert got == {"alchemy/alc_b1_index.htm": ("downloaded", 2, 1), "alchemy/alc_b2_index.htm": ("downloaded", 1, 1)}
    done = spark.createDataFrame([("sacred-texts", "alchemy/alc_b1_index.htm", "downloaded")], "source string, item_id string, status string")
    assert t.run(spark, site.get, done).count() == 1
    g = crawl.BookSearchCrawl(["salt"], "https://g.example/s?q={query}", "https://g.example/{id}.txt", delay=0)
    assert {r["item_id"]: r["status"] for r in g.run(spark, site.get, none).collect()} == {"12": "downloaded", "13": "failed"}
    a = crawl.ArchiveCrawl(["x"], lambda q: [{"identifier": i, "title": i.upper()} for i in ("a", "b", "c")], lambda i: [{"name": f"{i}.TXT", "format": "Text"}] if i != "b" else [{"name": "b.png", "format": "Image"}], cap=2)
    assert {r["item_id"]: (r["status"], r["files"]) for r in a.run(spark, site.get, none).collect()} == {"a": ("downloaded", ["a.TXT"]), "b": ("failed", None)}
    assert crawl.archive_query("x") == "x AND mediatype:texts"
    both = crawl.run_crawls(spark, [t, g], site.get, none, {"gutenberg": False})
    assert both.count() == 2 and crawl.run_crawls(spark, [t], site.get, none, only="other") is None


def test_streams(spark, tmp_path):
    rows = [("a", "same", "2025-01-01 00:00:00"), ("b", "same", "2025-01-01 01:00:00"), ("c", "other", "2025-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "id string, text string, at string").withColumn("at", F.col("at").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.stream_parquet(spark, str(tmp_path / "in"), df.schema)
    q = incremental.deduplicated(stream, "at").writeStream.format("memory").queryName("kept").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select text from kept").count() == 2
    for want in (3, 3):  # a second run finds nothing new
        incremental.embed_new(incremental.stream_parquet(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).count() == want
    q = incremental.arrivals(incremental.stream_parquet(spark, str(tmp_path / "in"), df.schema), "at", "text").writeStream.outputMode("complete").format("memory").queryName("days").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["text"], r["n"]) for r in spark.sql("select * from days").collect()} == {("same", 2), ("other", 1)}
