"""Registered queries of the engine's own operators, with the SQL that must give the same rows.

Every query runs over its whole tables. Queries without SQL are those SQL has no form for (Unicode folding, models,
projections, density clusters); tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.titles import fuzzy_title_links, indel_ratio
from corpusloom.functions.vectors import norm
from corpusloom.operators import chunking, dedup, density, embedding, export, gates, manifest, projection, similarity, topics, versions
from corpusloom.plans import pipeline
from corpusloom.session import balanced, table
from corpusloom.sources import crawl, html
from corpusloom.streaming import incremental

QUERIES: dict = {}
SQL: dict[str, str] = {}

# ---- pieces of SQL -------------------------------------------------------------------------------------------------------

_S = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_W = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_S}+|{_S}+$', '', 'g')"


def _lines(x: str) -> str:
    parts = rf"string_split_regex({x}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    return f"(CASE WHEN list_last({parts}) = '' THEN {parts}[:-2] ELSE {parts} END)"


_NL2 = "chr(10) || chr(10)"


def _normalized(source: str, key: str, columns: str = "") -> str:
    """Common table expressions n0..n4 ending in ``norm(key, text, ..)``."""
    more = f", {columns}" if columns else ""
    keep = f"length({_strip('x')}) > 2 OR regexp_matches({_strip('x')}, '^[A-Za-z0-9]{{2}}$') OR regexp_matches({_strip('x')}, '^[IVXLCDM]+$')"
    tidy = _strip("regexp_replace(x, '[ \\t]+', ' ', 'g')")
    return rf"""
        n1 AS (SELECT {key}{more}, regexp_replace(text, '({_W})-{_S}*\n{_S}*({_W})', '\1\2', 'g') AS text FROM {source}),
        n2 AS (SELECT {key}{more}, array_to_string(list_filter({_lines('text')}, lambda x: {keep}), chr(10)) AS text FROM n1),
        n3 AS (SELECT {key}{more}, regexp_replace(text, '\n{_S}*\p{{Nd}}{{1,4}}{_S}*\n', {_NL2}, 'g') AS text FROM n2),
        n4 AS (SELECT {key}{more}, array_to_string(list_transform({_lines('text')}, lambda x: {tidy}), chr(10)) AS text FROM n3),
        norm AS (SELECT {key}{more}, {_strip(f"regexp_replace(text, chr(10) || '{{3,}}', {_NL2}, 'g')")} AS text FROM n4)"""


_ONE = "one AS (SELECT id, any_value(text) AS text, min(title) AS title, min(source) AS source, min(tradition) AS tradition, min(char_count) AS char_count FROM corpus GROUP BY id)"


def _weird(x: str, n: int) -> str:
    head = f"left({x}, {n})"
    return rf"(CASE WHEN length({head}) > 0 THEN (length({head}) - length(regexp_replace({head}, '[^\x00-\x7f]|[|{{}}\[\]<>\\^~`]', '', 'g')))::DOUBLE / length({head}) ELSE 0.0 END)"


def _sparse(x: str) -> str:
    lines = f"list_filter(list_transform({_lines(f'left({x}, 2000)')}, lambda x: {_strip('x')}), lambda x: length(x) > 0)"
    return f"(len({lines}) >= 10 AND len(list_filter({lines}, lambda x: length(x) <= 3)) * 2 > len({lines}))"


def _garbled(x: str) -> str:
    return f"coalesce(length({x}) = 0 OR {_weird(x, 2000)} > 0.10 OR {_sparse(x)}, TRUE)"


def _outcome(x: str) -> str:
    return f"(CASE WHEN coalesce(length({_strip(x)}), 0) < 200 THEN 'too_short' WHEN {_garbled(x)} THEN 'garbled' ELSE 'kept' END)"


def _score(x: str) -> str:
    words = f"list_filter(string_split_regex(left({x}, 5000), '{_S}+'), lambda w: w <> '')"
    mean = f"length(array_to_string({words}, ''))::DOUBLE / greatest(len({words}), 1)"
    n = f"length({_strip(x)})::DOUBLE"
    return f"(CASE WHEN {n} > 0 THEN {n} * (1.0 - {_weird(x, 5000)}) * least({mean} / 5.0, 1.0) ELSE 0.0 END)"


def _hash(x: str, n: int, low: bool) -> str:
    s = f"left({_strip(x)}, {n})"
    return f"sha256({f'lower({s})' if low else s})"


_LATIN = ", ".join(f"'{w}'" for w in T.LATIN_WORDS)


def _latin(x: str) -> str:
    words = rf"list_transform(string_split_regex(lower({x}), '{_S}+'), lambda w: regexp_replace(w, '^[.,;:!?""''()]+|[.,;:!?""''()]+$', '', 'g'))".replace('""', '"')
    return f"len(list_distinct(list_filter({words}, lambda w: w IN ({_LATIN}))))"


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _one(spark: SparkSession, d: str) -> DataFrame:
    """One row per corpus id: re-delivered rows carry equal texts; of other columns the least value counts."""
    c = table(spark, d, "corpus")
    return c.groupBy("id").agg(F.any_value("text", True).alias("text"), *[F.min(x).alias(x) for x in ("title", "source", "tradition", "char_count")])


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """The corpus for text steps: as scanned if that gives work to all cores."""
    return balanced(table(spark, d, "corpus").select("id", "text"), "id")


# ---- search and similarity ---------------------------------------------------------------------------------------------

_UNIT = "SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings"


@register(f"""
    WITH e AS ({_UNIT}), u AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM e WHERE list_dot_product(v, v) > 0),
    s AS (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v) AS score FROM u q, u x WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)
    SELECT query_id, rank::INT AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 10
""")
def semantic_search_topk(spark, d):
    """Every vector whose id is divisible by 50 is a query against all vectors."""
    v = table(spark, d, "embeddings")
    q = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return similarity.search_all(v, q, "vec_id", "embedding", 10).withColumn("score", F.round("score", 6))


@register(f"""
    WITH e AS ({_UNIT}), q AS (SELECT v FROM e ORDER BY vec_id LIMIT 1),
    s AS (SELECT e.vec_id, e.label, list_dot_product(e.v, q.v) / sqrt(list_dot_product(q.v, q.v)) AS score FROM e, q WHERE label = 3),
    r AS (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT vec_id, label, round(score, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 10
""")
def semantic_search_filtered(spark, d):
    v = table(spark, d, "embeddings")
    query = v.orderBy("vec_id").first()["embedding"]
    return similarity.semantic_search(v, query, "vec_id", "embedding", 10, {"label": 3}).withColumn("score", F.round("score", 6))


_CENTROID = """
    d AS (SELECT {g} AS g, i AS dim, avg(v[i + 1]::DOUBLE) AS m FROM {t}, range(64) r(i) WHERE {g} IS NOT NULL AND v IS NOT NULL GROUP BY ALL),
    c AS (SELECT g, dim::INT AS dim, m / sqrt(sum(m * m) OVER (PARTITION BY g)) AS value FROM d)"""


@register("WITH e AS (SELECT label, embedding AS v FROM embeddings)," + _CENTROID.format(g="label", t="e") + " SELECT g AS label, dim, round(value, 6) AS value FROM c")
def group_centroids(spark, d):
    return similarity.centroids(table(spark, d, "embeddings"), "label", "embedding").withColumn("value", F.round("value", 6))


@register("WITH e AS (SELECT label, embedding AS v FROM embeddings)," + _CENTROID.format(g="label", t="e") + " SELECT x.g AS a, y.g AS b, round(sum(x.value * y.value), 6) AS sim FROM c x JOIN c y USING (dim) GROUP BY x.g, y.g")
def similarity_matrix(spark, d):
    return similarity.similarity_matrix(table(spark, d, "embeddings"), "label", "embedding").withColumn("sim", F.round("sim", 6))


@register("""
    WITH m AS (SELECT chunk_id, min(tradition) AS tradition FROM metadata GROUP BY chunk_id),
    u AS (SELECT chunk_id, any_value(vector) AS v FROM chunk_vectors GROUP BY chunk_id),
    e AS (SELECT tradition, v FROM u JOIN m USING (chunk_id) WHERE v IS NOT NULL),""" + _CENTROID.format(g="tradition", t="e") + """
    SELECT x.g AS a, y.g AS b, round(sum(x.value * y.value), 3) AS value FROM c x JOIN c y USING (dim) GROUP BY x.g, y.g""")
def similarity_heatmap(spark, d):
    """Traditions against each other, from the vectors of their chunks."""
    m = table(spark, d, "metadata").groupBy("chunk_id").agg(F.min("tradition").alias("tradition"))
    v = table(spark, d, "chunk_vectors").where("vector is not null").dropDuplicates(["chunk_id"])
    return similarity.heatmap(similarity.similarity_matrix(v.join(m, "chunk_id"), "tradition"))


# ---- text scalars --------------------------------------------------------------------------------------------------------


@register(f"WITH {_normalized('corpus', 'id')} SELECT id, text FROM norm")
def normalize_text(spark, d):
    """All steps but Unicode folding, which SQL lacks (see nfkc_folding)."""
    return _texts(spark, d).select("id", T.normalize_text(F.col("text"), fold=False).alias("text"))


#: Compatibility characters and their folded forms, for the SQL that has no such function: all that occur in the test tables, and others.
_FOLDED = {"¼": "1⁄4", "½": "1⁄2", "¾": "3⁄4", "\u00a0": " ", "ſ": "s", "™": "TM", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "²": "2", "³": "3", "¹": "1", "ª": "a", "º": "o", "…": "...", "\u2003": " ", "\u2009": " ", "ﬆ": "st"}


def _fold_sql(x: str) -> str:
    for a, b in _FOLDED.items():
        x = f"replace({x}, '{a}', '{b}')"
    return x


@register(f"WITH folded AS (SELECT id, {_fold_sql('text')} AS text FROM (SELECT id, text FROM corpus UNION ALL SELECT 'made', 'Long lines of text: {' and '.join(_FOLDED)} here.')), {_normalized('folded', 'id')} SELECT id, text FROM norm")
def nfkc_folding(spark, d):
    """Of the texts of the corpus and of one that holds every folded character of the SQL."""
    made = spark.createDataFrame([("made", f"Long lines of text: {' and '.join(_FOLDED)} here.")], "id string, text string")
    return _texts(spark, d).unionByName(made).select("id", T.normalize_text(F.col("text")).alias("text"))


def _vote_sql(x: str, least: int = 3) -> str:
    found = f"regexp_extract_all(lower({x}), '\\p{{L}}+')".replace("\\\\", "\\")
    n = {k: f"len(list_filter({found}, lambda w: w IN ({', '.join(repr(w) for w in v)})))" for k, v in T.FREQUENT_WORDS.items()}
    top = f"greatest({', '.join(n.values())})"
    return f"CASE WHEN {top} < {least} THEN NULL {' '.join(f'WHEN {v} = {top} THEN {k!r}' for k, v in n.items())} END"


@register(f"SELECT id, CASE WHEN {_latin('left(text, 1000)')} >= 3 THEN 'la' ELSE coalesce({_vote_sql('left(text, 1000)')}, 'en') END AS language FROM corpus WHERE text IS NOT NULL")
def language_labels(spark, d):
    """Latin by its word list, other languages by a given detector."""
    return _texts(spark, d).where("text is not null").select("id", T.detect_language(F.col("text"), T.word_vote()).alias("language"))


@register(f"SELECT id, round({_weird('text', 2000)}, 6) AS weird, {_sparse('text')} AS sparse, {_garbled('text')} AS garbled FROM corpus")
def garbled_flags(spark, d):
    t = F.col("text")
    return _texts(spark, d).select("id", F.round(T.weird_ratio(t), 6).alias("weird"), T.is_sparse(t).alias("sparse"), T.is_garbled(t).alias("garbled"))


@register(f"SELECT id, round({_score('text')}, 6) AS score FROM corpus")
def quality_score(spark, d):
    return _texts(spark, d).select("id", F.round(T.quality_score(F.col("text")), 6).alias("score"))


@register(f"SELECT id, {_hash('text', 2000, True)} AS process_hash, {_hash('text', 5000, False)} AS export_hash FROM corpus")
def content_hash_prefix(spark, d):
    t = F.col("text")
    return _texts(spark, d).select("id", T.content_hash(t).alias("process_hash"), T.content_hash(t, 5000, False).alias("export_hash"))


@register(f"SELECT id, {_latin('text')}::INT AS hits, {_latin('text')} >= 3 AS latin FROM corpus WHERE text IS NOT NULL")
def latin_detection(spark, d):
    t = F.col("text")
    return _texts(spark, d).where("text is not null").select("id", T.latin_hits(t).alias("hits"), T.is_latin(t).alias("latin"))


@register(f"SELECT id, regexp_replace({_strip('lower(title)')}, '{_S}+', ' ', 'g') AS title, replace(left(text, 200), chr(10), ' ') AS preview, coalesce(author, 'unknown') AS author FROM corpus")
def title_and_preview(spark, d):
    c = table(spark, d, "corpus")
    return c.select("id", T.normalize_title(F.col("title")).alias("title"), T.preview(F.col("text")).alias("preview"), T.coerce_string(F.col("author"), "unknown").alias("author"))


# ---- gates and duplicates --------------------------------------------------------------------------------------------------


@register(f"SELECT id, {_outcome('text')} AS outcome FROM corpus")
def quality_gate(spark, d):
    return gates.with_outcome(_texts(spark, d)).select("id", "outcome")


@register("SELECT id, title, " + " OR ".join("contains(lower(coalesce(title, '')), '{}')".format(x) for x in T.OFF_TOPIC_TITLES) + " AS off_topic FROM ("
    "SELECT id, title FROM corpus UNION ALL SELECT 'made-' || i, 'On ' || upper(f) || ', part ' || i FROM (SELECT unnest([" + ", ".join(f"'{x}'" for x in T.OFF_TOPIC_TITLES) + f"]) AS f, unnest(range({len(T.OFF_TOPIC_TITLES)})) AS i))")
def off_topic_split(spark, d):
    """The titles of the corpus and, as the fragments do not occur in them, one made of each fragment."""
    made = spark.createDataFrame([(f"made-{i}", f"On {x.upper()}, part {i}") for i, x in enumerate(T.OFF_TOPIC_TITLES)], "id string, title string")  # a row a fragment
    return table(spark, d, "corpus").select("id", "title").unionByName(made).select("id", "title", T.is_off_topic(F.col("title")).alias("off_topic"))


@register(f"""
    WITH h AS (SELECT doc_id, collected_at, {_hash('text', 2000, True)} AS content_hash FROM documents),
    f AS (SELECT *, first_value(doc_id) OVER (PARTITION BY content_hash ORDER BY collected_at NULLS FIRST, doc_id) AS first_id FROM h)
    SELECT doc_id, content_hash, CASE WHEN content_hash IS NOT NULL AND doc_id <> first_id THEN first_id END AS duplicate_of FROM f
""")
def dedup_keep_first(spark, d):
    return dedup.mark_duplicates(table(spark, d, "documents"), "doc_id", [F.col("collected_at")])


@register(f"""
    WITH h AS (SELECT doc_id, n_chars, {_hash('text', 5000, False)} AS h FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY coalesce(n_chars, -1) DESC, doc_id) AS r FROM h)
    SELECT doc_id, n_chars FROM r WHERE r = 1 OR h IS NULL
""")
def dedup_keep_longest(spark, d):
    return dedup.keep_longest(table(spark, d, "documents"), "doc_id", "n_chars").select("doc_id", "n_chars")


@register(f"SELECT count(h)::BIGINT AS rows, count(DISTINCT h)::BIGINT AS distinct_hashes, (count(h) - count(DISTINCT h))::BIGINT AS duplicates FROM (SELECT {_hash('text', 5000, False)} AS h FROM documents)")
def duplicates_removed(spark, d):
    return dedup.duplicate_count(table(spark, d, "documents"), "doc_id", prefix=5000, lowercase=False)


@register(f"SELECT doc_id FROM documents WHERE {_hash('text', 2000, True)} NOT IN (SELECT {_hash('text', 2000, True)} FROM corpus WHERE text IS NOT NULL) OR text IS NULL")
def dedup_against_existing(spark, d):
    stored = table(spark, d, "corpus").where("text is not null").select(T.content_hash(F.col("text")).alias("content_hash"))
    return dedup.against_existing(table(spark, d, "documents"), stored, "doc_id").select("doc_id")


# ---- the corpus build --------------------------------------------------------------------------------------------------------

_BUILD = f"""
    WITH {_ONE}, {_normalized('one', 'id', 'title, source, tradition')},
    o AS (SELECT *, {_outcome('text')} AS outcome, CASE WHEN {_latin('left(text, 1000)')} >= 3 THEN 'la' ELSE 'en' END AS language, length(text)::BIGINT AS char_count FROM norm),
    h AS (SELECT *, row_number() OVER (PARTITION BY outcome, {_hash('text', 2000, True)} ORDER BY source NULLS FIRST, id) AS r FROM o),
    p AS (SELECT *, CASE WHEN outcome <> 'kept' THEN outcome WHEN r > 1 THEN 'duplicate' ELSE 'processed' END AS result FROM h),
    k AS (SELECT *, row_number() OVER (PARTITION BY {_hash('text', 5000, False)} ORDER BY char_count DESC, id) AS kr FROM p
          WHERE result = 'processed' AND NOT ({" OR ".join("contains(lower(coalesce(title, '')), '{}')".format(x) for x in T.OFF_TOPIC_TITLES)})),
    c AS (SELECT id, coalesce(source, '') AS source, coalesce(tradition, 'unknown') AS tradition, language, char_count FROM k WHERE kr = 1)
"""


def _corpus(spark, d):
    processed = pipeline.process(_one(spark, d).drop("char_count"), fold=False)
    return export.export(processed.where("outcome = 'processed'"))[0]


@register(_BUILD + " SELECT source, count(*)::BIGINT AS documents, sum(char_count)::BIGINT AS chars FROM c GROUP BY source")
def corpus_summary_source(spark, d):
    return export.counts_by(_corpus(spark, d), "source")


@register(_BUILD + " SELECT language, count(*)::BIGINT AS documents, sum(char_count)::BIGINT AS chars FROM c GROUP BY language")
def corpus_summary_language(spark, d):
    return export.counts_by(_corpus(spark, d), "language")


@register(_BUILD + " SELECT id, source, tradition, language, char_count FROM c")
def corpus_export(spark, d):
    return _corpus(spark, d).select("id", "source", "tradition", "language", "char_count")


@register(_BUILD + " SELECT result AS outcome, count(*)::BIGINT AS n FROM p GROUP BY result")
def process_outcomes(spark, d):
    return pipeline.outcome_counts(pipeline.process(_one(spark, d).drop("char_count"), fold=False))


# ---- manifest --------------------------------------------------------------------------------------------------------------------

_LATEST = "l AS (SELECT *, row_number() OVER (PARTITION BY source, item_id ORDER BY recorded_at DESC NULLS LAST, status DESC NULLS LAST) AS r FROM manifest), latest AS (SELECT * FROM l WHERE r = 1)"


@register(f"WITH {_LATEST} SELECT source, item_id, status, recorded_at FROM latest")
def manifest_latest(spark, d):
    return manifest.latest(table(spark, d, "manifest")).select("source", "item_id", "status", "recorded_at")


@register(f"""
    WITH {_LATEST} SELECT CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source,
        count(*) FILTER (status = 'downloaded')::BIGINT AS downloaded, count(*) FILTER (status = 'failed')::BIGINT AS failed
    FROM latest GROUP BY ROLLUP (source)
""")
def scrape_status_rollup(spark, d):
    return manifest.status_rollup(manifest.latest(table(spark, d, "manifest")))


_ITEM = "SELECT DISTINCT id, split_part(id, '_', 1) AS source, substr(id, length(split_part(id, '_', 1)) + 2) AS item_id FROM corpus WHERE id IS NOT NULL"


def _items(spark, d):
    return table(spark, d, "corpus").where("id is not null").select("id", F.substring_index("id", "_", 1).alias("source"), F.expr("substring(id, length(substring_index(id, '_', 1)) + 2)").alias("item_id")).distinct()


@register(f"""
    WITH {_LATEST}, i AS ({_ITEM}), p AS (SELECT *, 'part.html' AS tail FROM i UNION ALL SELECT *, 'vol/2/part.html' FROM i UNION ALL SELECT id, source, 'no-such/' || item_id, 'x.txt' FROM i)
    SELECT p.id, tail, m.item_id AS manifest_item_id, m.status AS manifest_status FROM p LEFT JOIN latest m ON m.source = p.source AND m.item_id = p.item_id
""")
def manifest_lookup(spark, d):
    """Files item/part.html, item/vol/2/part.html and some in an unknown folder, found by the longest leading part of their path that the
    manifest knows."""
    state = manifest.latest(table(spark, d, "manifest")).select("source", "item_id", "status")
    tails = F.explode(F.array(*[F.struct(F.lit(a).alias("head"), F.lit(b).alias("tail")) for a, b in (("", "part.html"), ("", "vol/2/part.html"), ("no-such/", "x.txt"))]))
    files = _items(spark, d).withColumn("_t", tails).withColumn("tail", F.col("_t.tail")).withColumn("path", F.concat("_t.head", "item_id", F.lit("/"), "tail")).drop("_t")
    return manifest.look_up(files, state).select("id", "tail", "manifest_item_id", "manifest_status")


@register(f"WITH {_LATEST}, i AS ({_ITEM}) SELECT source, item_id FROM i WHERE NOT EXISTS (SELECT 1 FROM latest m WHERE m.status = 'downloaded' AND m.source = i.source AND m.item_id = i.item_id)")
def pending_downloads(spark, d):
    return manifest.pending(_items(spark, d), manifest.latest(table(spark, d, "manifest"))).select("source", "item_id")


@register("SELECT stage, error_type, count(*)::BIGINT AS n, count(DISTINCT item_id)::BIGINT AS items FROM error_log GROUP BY ALL")
def error_summary(spark, d):
    return table(spark, d, "error_log").groupBy("stage", "error_type").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("items"))


@register("SELECT work_id, doc_id FROM (SELECT work_id, doc_id, row_number() OVER (PARTITION BY work_id ORDER BY doc_id) AS r FROM documents WHERE work_id IS NOT NULL) WHERE r <= 50")
def capped_results(spark, d):
    """The cap of results per search term, on documents per work."""
    return crawl.cap_per_term(table(spark, d, "documents").where("work_id is not null").select("work_id", "doc_id"), 50, "doc_id", "work_id")


@register("SELECT id, tradition || '/' || replace(trim(regexp_extract(source_url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/', '_') AS item FROM corpus")
def url_to_id(spark, d):
    return table(spark, d, "corpus").select("id", html.url_to_id(F.col("tradition"), F.col("source_url")).alias("item"))


# ---- versions and titles ---------------------------------------------------------------------------------------------------------

_PAIRS = f"""
    WITH {_ONE}, s AS (SELECT id, {_score("coalesce(text, '')")} AS score FROM one),
    v AS (SELECT p.id AS base, p.score AS plain_score, x.score AS djvu_score, CASE WHEN p.score > x.score THEN 'pdf' WHEN x.score > p.score THEN 'djvu' ELSE 'tie' END AS winner
          FROM s p JOIN s x ON ends_with(x.id, '_djvu') AND replace(x.id, '_djvu', '') = p.id)
"""


@register(_PAIRS + " SELECT base, round(plain_score, 6) AS plain_score, round(djvu_score, 6) AS djvu_score, winner FROM v")
def pick_best_version(spark, d):
    v = versions.compare_versions(_one(spark, d))
    return v.select("base", F.round("plain_score", 6).alias("plain_score"), F.round("djvu_score", 6).alias("djvu_score"), "winner")


@register(_PAIRS + " SELECT winner, count(*)::BIGINT AS n FROM v GROUP BY winner")
def version_winners(spark, d):
    return versions.winner_counts(_one(spark, d))


_TITLE = lambda x: f"regexp_replace({_strip(f'lower({x})')}, '{_S}+', ' ', 'g')"


@register(rf"""
    WITH {_LATEST}, {_ONE}, i AS ({_ITEM}),
    t AS (SELECT i.id, {_TITLE('one.title')} AS a, {_TITLE('m.title')} AS b FROM i JOIN one ON one.id = i.id JOIN latest m ON m.source = i.source AND m.item_id = i.item_id WHERE one.title IS NOT NULL AND m.title IS NOT NULL),
    q AS (SELECT id, a, b, list_transform(string_split(a, ''), lambda x: [unicode(x)]) AS xs, list_transform(string_split(b, ''), lambda x: unicode(x)) AS ys FROM t),
    z AS (SELECT id, a, b, list_last(list_reduce(xs, lambda row, x: list_reduce(
             list_transform(range(1, len(ys) + 1), lambda j: [j]),
             lambda acc, j: list_append(acc, CASE WHEN ys[j[1]] = x[1] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], list_last(acc)) END), [0::BIGINT]),
             list_transform(range(0, len(ys) + 1), lambda j: 0::BIGINT))) AS lcs FROM q WHERE a <> '' AND b <> '')
    SELECT id, round(2.0 * lcs / (length(a) + length(b)), 6) AS ratio, 2.0 * lcs / (length(a) + length(b)) >= 0.85 AS duplicate FROM z
""")
def title_agreement(spark, d):
    """The title of each record against the title its manifest item carries."""
    m = manifest.latest(table(spark, d, "manifest")).select("source", "item_id", F.col("title").alias("b"))
    t = _items(spark, d).join(_one(spark, d).select("id", F.col("title").alias("a")), "id").join(m, ["source", "item_id"])
    t = t.select("id", T.normalize_title(F.col("a")).alias("a"), T.normalize_title(F.col("b")).alias("b")).where("a <> '' and b <> ''")
    t = t.withColumn("r", indel_ratio("a", "b"))
    return t.select("id", F.round("r", 6).alias("ratio"), (F.col("r") >= 0.85).alias("duplicate"))


@register()
def fuzzy_titles(spark, d):
    """How many other records have a title like each record's, at 0.85."""
    return fuzzy_title_links(_one(spark, d).select("id", "title"), "id")


# ---- chunks -------------------------------------------------------------------------------------------------------------------------

_HEADING = r"(?:Chapter|CHAPTER|Section|SECTION)\s+[\dIVXLCDM]+"
_CHAPTERS = rf"""
    WITH {_ONE}, m AS (SELECT id, text, string_split(regexp_replace(text, '\n({_HEADING}[.:]\s*\S)', chr(1) || '\1', 'g'), chr(1)) AS parts FROM one WHERE text IS NOT NULL),
    k AS (SELECT id, CASE WHEN len(parts) <= 1 THEN [{_strip('text')}] ELSE list_filter(list_transform(parts, lambda p: {_strip('p')}), lambda p: p <> '') END AS parts, len(parts) <= 1 AS whole FROM m),
    u AS (SELECT id, whole, unnest(parts) AS p, generate_subscripts(parts, 1) - 1 AS chapter_no FROM k),
    f AS (SELECT *, {_strip("split_part(p, chr(10), 1)")} AS first FROM u),
    c AS (SELECT id, chapter_no::INT AS chapter_no, CASE WHEN NOT whole AND regexp_matches(first, '^{_HEADING}') THEN first ELSE '' END AS chapter,
                 CASE WHEN NOT whole AND regexp_matches(first, '^{_HEADING}') THEN {_strip('substr(p, length(first) + 1)')} ELSE p END AS text FROM f),
    ch AS (SELECT * FROM c WHERE length({_strip('text')}) > 0)
"""
_CHUNKS = _CHAPTERS + f""",
    t AS (SELECT *, list_filter(string_split_regex({_strip('text')}, '{_S}+'), lambda w: w <> '') AS tok FROM ch),
    w AS (SELECT *, CASE WHEN len(tok) <= 64 THEN 1 ELSE ceil((len(tok) - 64) / 56.0)::INT + 1 END AS n FROM t),
    b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY id ORDER BY chapter_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM w),
    x AS (SELECT *, unnest(range(n)) AS pos FROM b),
    chunks AS (SELECT id, chapter, id || '_' || lpad((base + pos)::VARCHAR, 5, '0') AS chunk_id, pos::INT AS position_in_chapter, array_to_string(tok[pos * 56 + 1 : pos * 56 + 64], ' ') AS text FROM x)
"""


@register(_CHAPTERS + " SELECT id, chapter_no, chapter, text FROM ch")
def chapter_split(spark, d):
    return chunking.chapter_rows(_one(spark, d).select("id", "text"), "id").select("id", "chapter_no", "chapter", "text")


_SMALL = chunking.Profile("small", 64, 8)


@register(_CHUNKS + " SELECT * FROM chunks")
def sliding_window_chunks(spark, d):
    """Windows of 64 tokens with an overlap of 8, so that these short texts have several."""
    return chunking.chunk(_one(spark, d).select("id", "text"), "id", _SMALL).select("id", "chapter", "chunk_id", "position_in_chapter", "text")


@register(_CHUNKS + " SELECT id, count(*)::BIGINT AS chunks FROM chunks GROUP BY id")
def chunk_counts(spark, d):
    return chunking.chunk(_one(spark, d).select("id", "text"), "id", _SMALL).groupBy("id").agg(F.count("*").alias("chunks"))


_PROFILE_N = lambda p: f"CASE WHEN len(tok) <= {p.size} THEN 1 ELSE ceil((len(tok) - {p.size}) / {p.size - p.overlap}.0)::INT + 1 END"


@register(_CHAPTERS + f""",
    t AS (SELECT *, list_filter(string_split_regex({_strip('text')}, '{_S}+'), lambda w: w <> '') AS tok FROM ch)
    """ + " UNION ALL ".join(f"SELECT '{p.name}' AS profile, id, sum({_PROFILE_N(p)})::BIGINT AS chunks FROM t GROUP BY id" for p in (chunking.SEARCH, chunking.CLUSTER)))
def chunk_profiles(spark, d):
    """Chunks of every document under the two profiles in use."""
    one = _one(spark, d).select("id", "text")
    both = chunking.chunk(one, "id", chunking.SEARCH).select("profile", "id").unionByName(chunking.chunk(one, "id", chunking.CLUSTER).select("profile", "id"))
    return both.groupBy("profile", "id").agg(F.count("*").alias("chunks"))


@register(f"SELECT doc_id, len(t)::INT AS n, array_to_string(t[:100], ' ') AS head FROM (SELECT doc_id, list_filter(string_split_regex({_strip('text')}, '{_S}+'), lambda w: w <> '') AS t FROM documents WHERE text IS NOT NULL)")
def truncated_tokens(spark, d):
    t = T.whitespace_tokens(F.col("text"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(t).alias("n"), F.array_join(chunking.truncate_tokens(t, 102), " ").alias("head"))


# ---- clusters and topics ---------------------------------------------------------------------------------------------------------

#: Words that are no topic, of both the query and its SQL; the operator itself takes any list, by default that of Spark.
_STOP_WORDS = "a about after all an and any are as at be been but by for from had has have he her his how if in into is it its my no nor not of on or our she so that the their them they this to was we were what when where which who will with would you your".split()


def _topic_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in _STOP_WORDS)
    return rf"""
        WITH m AS (SELECT cluster, text FROM metadata WHERE cluster IS NOT NULL AND cluster <> -1),
        w AS (SELECT cluster, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM m WHERE text IS NOT NULL),
        tf AS (SELECT cluster, term, count(*) AS tf FROM w WHERE term NOT IN ({stop}) GROUP BY ALL),
        n AS (SELECT count(DISTINCT cluster) AS n FROM m),
        v AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 1000),
        x AS (SELECT cluster, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN v USING (term), n),
        s AS (SELECT cluster, term, w / sqrt(sum(w * w) OVER (PARTITION BY cluster)) AS weight FROM x),
        r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(weight, 9) DESC, term DESC) AS rank FROM s)
        SELECT cluster, rank::INT AS rank, term, round(weight, 6) AS weight FROM r WHERE rank <= 5
    """


@register(_topic_sql())
def cluster_topic_terms(spark, d):
    return topics.top_terms(table(spark, d, "metadata"), stop=_STOP_WORDS).withColumn("weight", F.round("weight", 6))


@register("SELECT cluster, count(*)::BIGINT AS size FROM metadata WHERE cluster IS NOT NULL GROUP BY cluster")
def cluster_sizes(spark, d):
    return topics.cluster_sizes(table(spark, d, "metadata"))


@register("SELECT count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END)::BIGINT AS clusters, count(*) FILTER (cluster = -1)::BIGINT AS noise, count(*) FILTER (cluster IS NULL)::BIGINT AS unassigned FROM metadata")
def cluster_totals(spark, d):
    return topics.cluster_totals(table(spark, d, "metadata"))


@register()
def density_clusters(spark, d):
    return density.density_clusters(table(spark, d, "embeddings"), "vec_id", "embedding")


@register()
def pca_projection(spark, d):
    c = projection.reduce_dimensions(table(spark, d, "embeddings"), "vec_id", "embedding")
    return projection.scatter(table(spark, d, "embeddings"), c, "vec_id", "label")


# ---- embedding ------------------------------------------------------------------------------------------------------------------------


@register("SELECT chunk_id, CASE WHEN coalesce(regexp_matches(text, '\\S'), FALSE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm, 64::INT AS dims FROM (SELECT DISTINCT chunk_id, text FROM metadata)")
def hash_embed_norms(spark, d):
    """Vectors of the default model have length one, those of texts without words zero."""
    v = embedding.embed(table(spark, d, "metadata").select("chunk_id", "text").distinct())
    return v.select("chunk_id", F.round(norm(F.col("vector")), 3).alias("norm"), F.size("vector").alias("dims"))


@register("SELECT DISTINCT chunk_id FROM metadata WHERE chunk_id NOT IN (SELECT chunk_id FROM chunk_vectors WHERE chunk_id IS NOT NULL)")
def incremental_anti_join(spark, d):
    return gates.only_new(table(spark, d, "metadata").select("chunk_id").distinct(), table(spark, d, "chunk_vectors"), "chunk_id")


@register("""
    WITH o AS (SELECT DISTINCT chunk_id FROM chunk_vectors), m AS (SELECT DISTINCT chunk_id FROM metadata)
    SELECT chunk_id, FALSE AS new FROM o UNION ALL SELECT chunk_id, TRUE FROM m WHERE chunk_id NOT IN (SELECT chunk_id FROM o)
""")
def incremental_union(spark, d):
    done = table(spark, d, "chunk_vectors").select("chunk_id", "vector").dropDuplicates(["chunk_id"])
    new = table(spark, d, "metadata").select("chunk_id", "text").dropDuplicates(["chunk_id"]).withColumn("new", F.lit(True))
    return embedding.embed_incremental(new, done, "chunk_id").select("chunk_id", F.coalesce("new", F.lit(False)).alias("new"))


@register("SELECT count(DISTINCT id)::BIGINT AS documents, count(*)::BIGINT AS chunks FROM (SELECT DISTINCT chunk_id, id FROM metadata) m WHERE chunk_id IN (SELECT chunk_id FROM chunk_vectors)")
def embedding_coverage(spark, d):
    m = table(spark, d, "metadata").select("chunk_id", "id").distinct()
    return embedding.coverage(m.join(table(spark, d, "chunk_vectors").select("chunk_id").distinct(), "chunk_id", "left_semi"))


# ---- extraction -----------------------------------------------------------------------------------------------------------------------


def _pages(spark, d):
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(
        F.lit("<html><head><title>x</title><script>var a = 1;</script></head><body><nav>Home</nav><div class='SideBar'>menu</div><h1>"), esc(F.col("title")),
        F.lit("</h1><p>"), esc(F.col("text")), F.lit("<br></p><h2> </h2><footer>end</footer></body></html>"),
    )
    return table(spark, d, "documents").select("doc_id", page.alias("html"))


@register(f"SELECT doc_id, array_to_string(list_filter(list_transform({_lines('t')}, lambda x: {_strip('x')}), lambda x: x <> ''), chr(10)) AS text FROM (SELECT doc_id, coalesce(title, '') || chr(10) || coalesce(text, '') AS t FROM documents)")
def html_text(spark, d):
    """Pages made of every document, with furniture that must leave."""
    return _pages(spark, d).select("doc_id", html.html_page("html")["text"].alias("text"))


@register(f"SELECT doc_id, {_strip('title')} AS heading FROM documents WHERE {_strip('title')} <> ''")
def html_headings(spark, d):
    return _pages(spark, d).select("doc_id", F.explode(html.html_page("html")["chapters"]).alias("heading"))


@register(f"SELECT id, sum(coalesce(length({_strip('text')}), 0))::BIGINT AS chars, count(*)::BIGINT AS pages, sum(coalesce(length({_strip('text')}), 0)) < 10 * count(*) AS scanned FROM metadata GROUP BY id")
def page_totals(spark, d):
    """Characters and pages of a document, and whether it counts as scanned; chunks stand for pages."""
    per = table(spark, d, "metadata").groupBy("id").agg(F.sum(F.coalesce(F.length(T.strip(F.col("text"))), F.lit(0))).alias("chars"), F.count("*").alias("pages"))
    return per.withColumn("scanned", gates.is_scanned(F.col("chars"), F.col("pages")))


@register(rf"""
    WITH p AS (SELECT id, CASE WHEN coalesce(ocr_used, FALSE) THEN '' ELSE text END AS extracted, text AS recognised FROM corpus WHERE text IS NOT NULL),
    q AS (SELECT *, length({_strip('extracted')}) < 10 OR {_garbled('extracted')} AS need FROM p)
    SELECT id, length(CASE WHEN need AND length({_strip('recognised')}) > length({_strip('extracted')}) THEN recognised ELSE extracted END)::INT AS chars, need AS ocr_used FROM q
""")
def ocr_choice(spark, d):
    """Recognised text replaces the extracted one where that is scanned or garbled and shorter."""
    c = table(spark, d, "corpus").where("text is not null").withColumn("extracted", F.when(F.coalesce("ocr_used", F.lit(False)), "").otherwise(F.col("text")))
    text, used = gates.choose_ocr(F.col("extracted"), F.lit(1), F.col("text"))
    return c.select("id", F.length(text).alias("chars"), used.alias("ocr_used"))


# ---- streams --------------------------------------------------------------------------------------------------------------------------


@register("SELECT (floor(epoch(loaded_at) / 2592000) * 2592000)::BIGINT AS start_s, file_type, count(*)::BIGINT AS n FROM corpus WHERE loaded_at IS NOT NULL GROUP BY ALL")
def stream_arrivals(spark, d):
    """Arrivals per 30 days and file type, counted by a stream over all files that are there; late rows count."""
    import uuid

    # a pattern, as a stream's path may not be a single file
    rows = incremental.stream_parquet(spark, f"{d}/corpus.parque[t]", table(spark, d, "corpus").schema)
    name = f"arrivals_{uuid.uuid4().hex}"
    counted = incremental.arrivals(rows, "loaded_at", "file_type", window="30 days")
    query = counted.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).select(F.col("start").cast("long").alias("start_s"), "file_type", "n")
