"""Crawls as DataFrame steps over an injected fetcher: pages are fetched in partitions, links exploded, known items anti-joined.

A fetcher is ``fetch(url) -> str | None``. ``http_fetcher`` makes one over the standard library with retries; tests inject a
dictionary. One partition per host keeps the delay between requests of a host.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.manifest import pending
from corpusloom.sources import html

Fetch = Callable[[str], "str | None"]
#: Statuses that are tried again.
RETRIED = (429, 500, 502, 503, 504)


def http_fetcher(retries: int = 3, backoff: float = 1.0, timeout: float = 30.0, agent: str = "corpusloom", opener=urllib.request.urlopen, sleep=time.sleep) -> Fetch:
    """None if the page can't be had."""

    def fetch(url: str) -> str | None:
        for attempt in range(retries + 1):
            try:
                with opener(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
                    return r.read().decode("utf-8", "replace")
            except urllib.error.HTTPError as e:
                if e.code not in RETRIED:
                    return None
            except OSError:
                pass
            if attempt < retries:
                sleep(backoff * 2**attempt)
        return None

    return fetch


def fetch_pages(urls: DataFrame, fetch: Fetch, url: str = "url", delay: float = 0.0) -> DataFrame:
    """Adds ``html``, null where the fetch failed. Rows of a host stay in one partition, one after another."""
    schema = urls.schema.add("html", "string")

    def run(batches):
        for pdf in batches:
            got = []
            for u in pdf[url]:
                if delay > 0:
                    time.sleep(delay)
                got.append(fetch(u))
            yield pdf.assign(html=got)

    return urls.repartition(F.parse_url(url, F.lit("HOST"))).mapInPandas(run, schema)


class Crawl(Protocol):
    """name of the source, seconds between requests, and the rows it finds: (source, item_id, status, ..)."""

    name: str
    delay: float

    def run(self, spark: SparkSession, fetch: Fetch, state: DataFrame) -> DataFrame: ...


#: Where the index page of each tradition lies.
TRADITION_PATHS = {
    "hermetic": "/eso/", "kabbalah": "/jud/", "alchemy": "/alc/", "grimoire": "/grim/", "enochian": "/eso/enoch/", "rosicrucian": "/sro/", "thelema": "/oto/", "gnostic": "/gno/",
}


@dataclass
class TraditionCrawl:
    """tradition page -> books -> chapters; unknown traditions are skipped. With ``store`` the fetched pages (source, item_id, tradition, url,
    html) are appended there as Parquet and counted from there."""

    base: str
    paths: dict[str, str] = field(default_factory=lambda: dict(TRADITION_PATHS))
    traditions: list[str] = field(default_factory=lambda: list(TRADITION_PATHS))
    name: str = "sacred-texts"
    delay: float = 1.5
    store: str | None = None

    def run(self, spark: SparkSession, fetch: Fetch, state: DataFrame) -> DataFrame:
        known = [(t, f"{self.base.rstrip('/')}/{self.paths[t].lstrip('/')}") for t in self.traditions if t in self.paths]
        top = spark.createDataFrame(known, "tradition string, url string")
        books = fetch_pages(top, fetch, delay=self.delay).where("html is not null").select("tradition", F.explode(html.tradition_links("html", "url")).alias("book_url"))
        books = books.withColumns({"source": F.lit(self.name), "item_id": html.url_to_id(F.col("tradition"), F.col("book_url"))}).dropDuplicates(["item_id"])
        todo = pending(books, state)
        # a book's links are resolved against, and must lie below, its folder
        pages = fetch_pages(todo, fetch, "book_url", self.delay).where("html is not null").withColumn("folder", F.regexp_replace("book_url", r"[^/]*$", ""))
        links = html.book_links("html", "folder")
        chapters = pages.select("source", "item_id", "tradition", "book_url", F.explode(F.when(F.size(links) > 0, links).otherwise(F.array("book_url"))).alias("url"))
        got = fetch_pages(chapters, fetch, delay=self.delay)
        if self.store:
            run = f"{self.store.rstrip('/')}/run={uuid.uuid4().hex}"
            got.write.option("compression", "zstd").parquet(run)
            got = spark.read.parquet(run)
        per = got.groupBy("source", "item_id", "tradition", "book_url").agg(F.count("*").alias("chapters"), F.count("html").alias("chapters_ok"))
        return per.withColumns({"status": F.when(F.col("chapters_ok") > 0, "downloaded").otherwise("failed"), "source_url": F.col("book_url"), "file_type": F.lit("html")}).drop("book_url")


def archive_query(term: str) -> str:
    return f"{term} AND mediatype:texts"


def wanted_format(name: Column, format_: Column, formats: list[str]) -> Column:
    """Its extension is a wanted format, or its format's name contains one."""
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return ext.isin(*[f.lower() for f in formats]) | reduce(lambda a, b: a | b, [F.contains(F.lower(format_), F.lit(f.lower())) for f in formats])


def cap_per_term(results: DataFrame, cap: int, order: str = "position", term: str = "term") -> DataFrame:
    """The first ``cap`` results of every term; items already there count."""
    return results.withColumn("_r", F.row_number().over(Window.partitionBy(term).orderBy(order))).where(F.col("_r") <= cap).drop("_r")


@dataclass
class ArchiveCrawl:
    """Search results per term by an injected search, capped per term; files of wanted formats by an injected listing, fetched by an injected
    download if one is given and there is a folder for them."""

    terms: list[str]
    search: Callable[[str], list[dict]]
    list_files: Callable[[str], list[dict]]
    cap: int = 50
    formats: list[str] = field(default_factory=lambda: ["txt", "pdf"])
    name: str = "internet-archive"
    delay: float = 1.5
    download: Callable[[str, str], bytes] | None = None
    store: str | None = None

    def _fetched(self, kept: DataFrame) -> DataFrame:
        """(item_id, files): the files that could be fetched, now below ``store``/item."""

        def get(batches):
            from corpusloom.sources.sinks import write_file

            for pdf in batches:
                rows = []
                for item, files in zip(pdf["item_id"], pdf["files"]):
                    there = []
                    for name in files:
                        try:
                            write_file(f"{self.store.rstrip('/')}/{item}/{name}", self.download(item, name))
                        except OSError:  # one file that fails leaves the others
                            continue
                        there.append(name)
                    rows.append((item, there))
                yield pd.DataFrame(rows, columns=["item_id", "files"])

        return kept.mapInPandas(get, "item_id string, files array<string>")

    def run(self, spark: SparkSession, fetch: Fetch, state: DataFrame) -> DataFrame:
        terms = spark.createDataFrame([(t,) for t in self.terms], "term string")

        def find(batches):
            for pdf in batches:
                rows = [(t, i, r["identifier"], r.get("title"), r.get("creator")) for t in pdf["term"] for i, r in enumerate(self.search(archive_query(t)))]
                yield pd.DataFrame(rows, columns=["term", "position", "item_id", "title", "author"])

        found = cap_per_term(terms.mapInPandas(find, "term string, position int, item_id string, title string, author string"), self.cap)
        todo = pending(found.dropDuplicates(["item_id"]).withColumn("source", F.lit(self.name)), state)

        def listing(batches):
            for pdf in batches:
                rows = [(i, f["name"], f.get("format", "")) for i in pdf["item_id"] for f in self.list_files(i)]
                yield pd.DataFrame(rows, columns=["item_id", "name", "format"])

        files = todo.select("item_id").mapInPandas(listing, "item_id string, name string, format string")
        kept = files.where(wanted_format(F.col("name"), F.col("format"), self.formats)).groupBy("item_id").agg(F.array_sort(F.collect_list("name")).alias("files"))
        if self.download and self.store:
            kept = self._fetched(kept)
        out = todo.join(kept, "item_id", "left")
        url = F.concat(F.lit("https://archive.example/details/"), F.col("item_id"))
        return out.select("source", "item_id", "title", F.coalesce("author", F.lit("unknown")).alias("author"), "files", F.when(F.size("files") > 0, "downloaded").otherwise("failed").alias("status"), url.alias("source_url"), F.lit("mixed").alias("file_type"))


@dataclass
class BookSearchCrawl:
    """First result page per term, then the plain text of every book not yet there."""

    terms: list[str]
    search_url: str
    text_url: str
    name: str = "gutenberg"
    delay: float = 1.5

    def run(self, spark: SparkSession, fetch: Fetch, state: DataFrame) -> DataFrame:
        terms = spark.createDataFrame([(t, self.search_url.format(query=t)) for t in self.terms], "term string, url string")
        found = fetch_pages(terms, fetch, delay=self.delay).where("html is not null").select(F.explode(html.result_entries("html")).alias("r")).select(F.col("r.ebook_id").alias("item_id"), "r.title", "r.author")
        todo = pending(found.dropDuplicates(["item_id"]).withColumn("source", F.lit(self.name)), state)
        url = F.replace(F.lit(self.text_url), F.lit("{id}"), F.col("item_id"))
        got = fetch_pages(todo.withColumn("url", url), fetch, delay=self.delay)
        return got.select("source", "item_id", "title", "author", F.col("url").alias("source_url"), F.lit("txt").alias("file_type"), F.col("html").alias("text"), F.when(F.col("html").isNull(), "failed").otherwise("downloaded").alias("status"))


def run_crawls(spark: SparkSession, crawls: list[Crawl], fetch: Fetch, state: DataFrame, enabled: dict[str, bool] | None = None, only: str = "all") -> DataFrame | None:
    """The rows of all enabled crawls (or of the one named), to be appended to the manifest log."""
    rows = [c.run(spark, fetch, state) for c in crawls if (enabled or {}).get(c.name, True) and only in ("all", c.name)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows) if rows else None
