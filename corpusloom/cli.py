"""Commands: process, pick-best, scrape, export, chunk, embed, search, cluster, similarity, visualize.

A model is named ``package.module:function``; the function takes nothing and gives a loader as ``operators.embedding`` takes it. A fetcher
is named the same way and takes a URL.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.config import load_config
from corpusloom.functions.text import preview, word_vote
from corpusloom.operators import chunking, density, embedding, export, manifest, projection, similarity, topics, versions
from corpusloom.plans import pipeline
from corpusloom.session import materialise
from corpusloom.sources import crawl, files, sinks


def named(path: str):
    """The object ``package.module:name``."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("process", help="raw files to cleaned, gated and deduplicated records")
    s.add_argument("raw"), s.add_argument("out"), s.add_argument("--skip-pdf", action="store_true"), s.add_argument("--sidecars"), s.add_argument("--summary"), s.add_argument("--errors")
    s = sub.add_parser("pick-best", help="the better of two versions of a text")
    s.add_argument("records"), s.add_argument("out")
    s = sub.add_parser("scrape", help="run the crawls of a configuration")
    s.add_argument("config"), s.add_argument("state", help="folder of the manifest log"), s.add_argument("--source", default="all"), s.add_argument("--fetch", help="package.module:function")
    s = sub.add_parser("search", help="print the chunks most like a query")
    s.add_argument("vectors"), s.add_argument("query"), s.add_argument("--top-k", type=int, default=10), s.add_argument("--tradition"), s.add_argument("--title"), s.add_argument("--model")
    for name in ("cluster", "similarity", "visualize"):
        s = sub.add_parser(name)
        s.add_argument("vectors"), s.add_argument("out")
        s.add_argument("--level", choices=("tradition", "title"), default="tradition")
        s.add_argument("--min-cluster-size", type=int, default=10), s.add_argument("--dimensions", type=int, default=50, help="reduce longer vectors before clustering")
        s.add_argument("--array"), s.add_argument("--html")
    s = sub.add_parser("chunk", help="cut documents into overlapping windows")
    s.add_argument("documents"), s.add_argument("out"), s.add_argument("--profile", choices=("search", "cluster", "all"), default="all"), s.add_argument("--tokenizer", help="a tokenizer file")
    s = sub.add_parser("embed", help="embed chunks of documents that have no vectors yet, part by part")
    s.add_argument("chunks"), s.add_argument("out"), s.add_argument("--force", action="store_true"), s.add_argument("--model"), s.add_argument("--parts", type=int, default=64), s.add_argument("--profile")
    s = sub.add_parser("export", help="write the typed corpus")
    s.add_argument("records"), s.add_argument("out"), s.add_argument("--summary")
    return p


def _crawls(config) -> tuple[list, dict[str, bool]]:
    """The crawls that the configuration's sources describe: ``kind`` says which, the rest are its fields."""
    kinds = {"tradition": crawl.TraditionCrawl, "books": crawl.BookSearchCrawl}
    found, enabled = [], {}
    for name, given in config.sources.items():
        given = dict(given)
        kind = kinds.get(given.pop("kind", ""))
        enabled[name] = given.pop("enabled", True)
        if kind:
            found.append(kind(**given, name=name))
    return found, enabled


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    read = spark.read.parquet
    model = named(a.model)() if getattr(a, "model", None) else embedding.hashed_words()
    if a.command == "process":
        raw = pipeline.extract(files.raw_files(spark, a.raw, skip_pdf=a.skip_pdf))
        done = sinks.with_metadata(materialise(pipeline.process(raw, detector=word_vote()).withColumn("file_type", F.ltrim(F.col("ext"), F.lit(".")))))
        done.write.mode("overwrite").option("compression", "zstd").parquet(a.out)
        done = read(a.out)
        if a.sidecars:
            sinks.write_sidecars(done.where("outcome = 'processed'").drop("outcome", "duplicate_of", "rel", "ext"), a.sidecars)
        counts = {r["outcome"]: r["n"] for r in pipeline.outcome_counts(done).collect()}  # a row an outcome
        if a.summary:
            sinks.write_summary(counts, a.summary)
        if a.errors:
            bad = done.where("outcome in ('garbled', 'too_short')")
            files.append_errors(bad.select(F.current_timestamp().cast("string").alias("timestamp"), F.lit("process").alias("stage"), "source", F.col("id").alias("item_id"), F.col("outcome").alias("error_type"), F.lit("").alias("traceback")), a.errors)
        print(counts)
    elif a.command == "pick-best":
        versions.compare_versions(read(a.records)).write.mode("overwrite").parquet(a.out)
        read(a.out).groupBy("winner").count().show()
    elif a.command == "scrape":
        found, enabled = _crawls(load_config(a.config))
        fetch = named(a.fetch) if a.fetch else crawl.http_fetcher()
        try:
            log = read(a.state)
        except Exception:  # nothing crawled yet
            log = spark.createDataFrame([], "source string, item_id string, status string, recorded_at timestamp")
        rows = crawl.run_crawls(spark, found, fetch, manifest.latest(log), enabled, a.source)
        if rows is not None:
            rows.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(a.state)
            manifest.status_rollup(manifest.latest(spark.read.option("mergeSchema", "true").parquet(a.state))).show()
    elif a.command == "search":
        query = model()([a.query])[0]
        where = {k: v for k, v in (("tradition", a.tradition), ("title", a.title)) if v}
        hits = similarity.semantic_search(read(a.vectors), query, "chunk_id", top_k=a.top_k, where=where)
        hits.select("rank", "tradition", "title", F.round("score", 4).alias("score"), preview(F.col("text")).alias("preview")).show(a.top_k, truncate=False)
    elif a.command == "cluster":
        df = read(a.vectors)
        first = df.select(F.size("vector").alias("d")).where("d > 0").first()
        points = df
        if first and first["d"] > a.dimensions:
            points = projection.reduce_dimensions(df, "chunk_id", components=a.dimensions).select("chunk_id", F.col("coords").alias("vector"))
        density.density_clusters(points, "chunk_id", min_cluster_size=a.min_cluster_size).write.mode("overwrite").parquet(a.out)
        labelled = df.drop("cluster").join(read(a.out), "chunk_id")
        topics.top_terms(labelled).orderBy("cluster", "rank").show(200, truncate=False)
        topics.cluster_totals(labelled).show()
    elif a.command == "similarity":
        similarity.similarity_matrix(read(a.vectors), a.level).write.mode("overwrite").parquet(a.out)
        m = read(a.out)
        similarity.matrix_table(m).show(100, truncate=False)
        if a.array:
            print(sinks.write_matrix(m, a.array))
        if a.html:
            sinks.heatmap_page(m, a.html, value="sim", title=f"Similarity by {a.level}")
    elif a.command == "visualize":
        df = read(a.vectors)
        projection.scatter(df, projection.reduce_dimensions(df, "chunk_id"), "chunk_id", a.level).write.mode("overwrite").parquet(a.out)
        if a.html:
            sinks.scatter_page(read(a.out), a.html, a.level, "Chunks by their principal components")
    elif a.command == "chunk":
        encode, decode = chunking.model_tokenizer(a.tokenizer) if a.tokenizer else (chunking.whitespace_tokens, None)
        out = None
        for p in (chunking.SEARCH, chunking.CLUSTER):
            if a.profile in ("all", p.name):
                c = chunking.chunk(read(a.documents), "id", p, tokenize=encode, decode=decode)
                out = c if out is None else out.unionByName(c)
        files.write_chunks(out, a.out)
    elif a.command == "embed":
        chunks = read(a.chunks)
        if a.profile:
            chunks = chunks.where(F.col("profile") == a.profile)
        parts = embedding.embed_in_parts(chunks, a.out, "chunk_id", a.parts, a.force, load=model)
        vectors = read(a.out)
        size = vectors.select(F.size("vector").alias("d")).first()
        sinks.write_file(f"{a.out.rstrip('/')}/_model.json", embedding.model_info(a.model or "hashed words", size["d"] if size else 0))
        print(f"{len(parts)} parts written")
    elif a.command == "export":
        corpus, misc = export.export(read(a.records))
        export.write_corpus(corpus, a.out)
        if a.summary:
            kept, before = read(a.out), read(a.records).count()
            aside = misc.count()
            sinks.write_summary(export.summary(kept, before - aside - kept.count(), aside), a.summary)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
