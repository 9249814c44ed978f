"""Registered queries of the training-data operators. Where SQL cannot express one, tests use brute force instead."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.llm import language, leakage, mcl, neardup, ocr, packing, quality, split, subjects, tokens
from corpusloom.llm.base import LANGUAGE_NAMES
from corpusloom.session import table

LIMITS = {"corpus": ("id", 4000, 300), "metadata": ("chunk_id", 2000, 150)}


def p1_found(spark, d):
    return language.mislabelled(table(spark, d, "corpus"))


def p1_segments(spark, d):
    """Every passage of every record with its language and confidence."""
    return language.label_languages(table(spark, d, "corpus"))


def p2_found(spark, d):
    return ocr.damaged_lines(table(spark, d, "corpus"))


def p2_repaired(spark, d):
    return ocr.repair(table(spark, d, "corpus"))


def _pieces(spark, d):
    out = None
    for name, (key, limit, overlap) in LIMITS.items():
        p = split.split_oversized(table(spark, d, name), key, limit, overlap).withColumnRenamed(key, "item_key").withColumn("table_name", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out.select("table_name", "item_key", "piece_no", "n_pieces", "start", "overlap_chars", "text")


def p3_found(spark, d):
    return _pieces(spark, d).where("piece_no = 0 and n_pieces > 1").select("table_name", "item_key")


def p3_pieces(spark, d):
    return _pieces(spark, d)


def p3_rebuilt(spark, d):
    """Of every oversized text: whether all pieces keep the limit and overlap, and a hash of the text put together again from them."""
    p = _pieces(spark, d)
    limit = F.when(F.col("table_name") == "corpus", LIMITS["corpus"][1]).otherwise(LIMITS["metadata"][1])
    overlap = F.when(F.col("table_name") == "corpus", LIMITS["corpus"][2]).otherwise(LIMITS["metadata"][2])
    ok = (F.length("text") <= limit) & (F.col("overlap_chars") <= overlap) & ((F.col("overlap_chars") > 0) == (F.col("piece_no") > 0))
    own = F.struct("piece_no", F.expr("substring(text, overlap_chars + 1)").alias("t"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(own)), lambda x: x["t"]), "")
    return p.groupBy("table_name", "item_key").agg(F.min(ok).alias("kept"), (F.max("n_pieces") == F.count("*")).alias("all_there"), F.md5(whole).alias("text_md5"))


def p4_found(spark, d):
    return neardup.NearDuplicates(table(spark, d, "corpus"), "id", shingle=3, threshold=0.5).pairs()


def p4_versions(spark, d):
    """One row per record: class of equal records, group and number of links, at five words and 0.8."""
    return neardup.NearDuplicates(table(spark, d, "corpus"), "id", short=True).versions()


def p4_links(spark, d):
    """How many other records each record with a shingle is a version of, at five words and 0.8."""
    return neardup.NearDuplicates(table(spark, d, "corpus"), "id").versions().select("id", "links")


def p5_token_budget(spark, d):
    pieces = tokens.read_pieces(table(spark, d, "tokenizer_vocab"))
    return tokens.token_cube(tokens.count_tokens(tokens.documents_with_slices(table(spark, d, "corpus")), "id", pieces))


def p5_documents(spark, d):
    pieces = tokens.read_pieces(table(spark, d, "tokenizer_vocab"))
    return tokens.count_tokens(tokens.documents_with_slices(table(spark, d, "corpus")), "id", pieces).select("id", "n_tokens")


def p6_found(spark, d):
    return mcl.VectorClusters(table(spark, d, "chunk_vectors")).pairs()


def p6_clusters(spark, d):
    """Every chunk of metadata with its cluster, -1 for noise."""
    found = mcl.VectorClusters(table(spark, d, "chunk_vectors")).checked().select("chunk_id", "cluster", "size")
    chunks = table(spark, d, "metadata").select("chunk_id").where("chunk_id is not null").distinct()
    return chunks.join(found, "chunk_id", "left").select("chunk_id", F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("size", F.lit(0)).alias("size"))


def p6_members(spark, d):
    """Every chunk of metadata with the least chunk of its cluster, which tells clusters apart whatever they are called, and the size."""
    found = p6_clusters(spark, d)
    least = found.where("cluster <> -1").groupBy("cluster").agg(F.min("chunk_id").alias("least_chunk"))
    return found.join(least, "cluster", "left").select("chunk_id", "least_chunk", "size")


def p6_described(spark, d):
    return mcl.VectorClusters(table(spark, d, "chunk_vectors")).described()


def p7_found(spark, d):
    return quality.text_quality(table(spark, d, "corpus")).where("kind <> 'prose'").select("id", "kind")


def p7_statistics(spark, d):
    return quality.text_quality(table(spark, d, "corpus"))


def p7_counts(spark, d):
    """The plain counts among the statistics."""
    return quality.text_quality(table(spark, d, "corpus")).select("id", "n_words", "n_chars", "n_lines")


def _packed(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), tokens.read_pieces(table(spark, d, "tokenizer_vocab")))


def p8_found(spark, d):
    return _packed(spark, d).where("piece_no = 0 and n_pieces > 1").select("doc_id")


def p8_containers(spark, d):
    return _packed(spark, d)


def p8_checked(spark, d):
    """Of every document with tokens: its size, whether all its containers keep their capacity and whether its pieces are all there, in order, once."""
    p = _packed(spark, d)
    load = p.groupBy("container").agg(F.sum("tokens").alias("load"))
    each = p.join(load, "container").groupBy("doc_id").agg(
        F.sum("tokens").alias("n_tokens"), (F.max("load") <= 1024).alias("fits"),
        F.array_sort(F.collect_list(F.struct("piece_no", "start", "end"))).alias("x"), F.max("n_pieces").alias("n_pieces"),
    )
    follows = F.forall(F.sequence(F.lit(0), F.col("n_pieces") - 1), lambda i: (F.get("x", i)["piece_no"] == i) & ((i == 0) | (F.get("x", i)["start"] >= F.get("x", i - 1)["end"])))
    return each.select("doc_id", "n_tokens", "fits", ((F.size("x") == F.col("n_pieces")) & follows).alias("whole"))


def p9_found(spark, d):
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p10_found(spark, d):
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects")).select("doc_id", "subject")


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_segments, p2_found, p2_repaired, p3_found, p3_pieces, p3_rebuilt, p4_found, p4_versions, p4_links, p5_token_budget, p5_documents, p6_found,
        p6_clusters, p6_members, p6_described, p7_found, p7_statistics, p7_counts, p8_found, p8_containers, p8_checked, p9_found, p10_found,
    )
}

_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')".replace("\\\\", "\\")
_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _grams(table_: str, key: str, size: int) -> str:
    return f"""(SELECT DISTINCT {key}, array_to_string(w[i : i + {size - 1}], ' ') AS g
        FROM (SELECT {key}, w, unnest(range(1, len(w) - {size - 2})) AS i FROM (SELECT {key}, {_WORDS} AS w FROM {table_} WHERE text IS NOT NULL) WHERE len(w) >= {size}))"""


def _tokens(table_: str, key: str) -> str:
    """Greedy longest pieces by recursion over the distinct words."""
    return rf"""
        WITH RECURSIVE src AS (SELECT {key}, any_value(text) AS text FROM {table_} WHERE text IS NOT NULL AND {key} IS NOT NULL GROUP BY {key}),
        words AS (SELECT {key}, unnest({_WORDS}) AS w FROM src),
        r AS (SELECT DISTINCT w, 0::BIGINT AS a, 0::BIGINT AS n FROM words
              UNION ALL
              SELECT w, a + max(CASE WHEN a = 0 THEN length(piece) ELSE length(piece) - 2 END), n + 1 FROM r JOIN tokenizer_vocab
              ON CASE WHEN a = 0 THEN starts_with(w, piece) ELSE starts_with(piece, '##') AND length(piece) > 2 AND starts_with(substr(w, a + 1), substr(piece, 3)) END
              WHERE a < length(w) AND piece <> '' GROUP BY w, a, n),
        per AS (SELECT w, coalesce(max(n) FILTER (a = length(w)), 1) AS n FROM r GROUP BY w),
        inside AS (SELECT {key}, sum(n) AS n FROM words JOIN per USING (w) GROUP BY {key}),
        sizes AS (SELECT src.{key}, (coalesce(inside.n, 0) + length(regexp_replace(lower(text), '[\p{{L}}\p{{N}}{_SPACE}]', '', 'g')))::BIGINT AS n_tokens FROM src LEFT JOIN inside USING ({key})
                  WHERE regexp_matches(text, '[^{_SPACE}]'))
    """


def _slug(c: str) -> str:
    s = rf"regexp_replace(lower(trim({c}, ' ')), '[\s_\-]+', '-', 'g')"
    return f"coalesce(nullif({s}, ''), 'unknown')"


def _language(c: str) -> str:
    head = rf"regexp_extract(lower(trim({c}, ' ')), '^(\p{{L}}+)', 1)"
    cases = " ".join(f"WHEN {head} IN ({', '.join(repr(n) for n in names)}) THEN '{code}'" for code, names in LANGUAGE_NAMES.items())
    return f"CASE {cases} ELSE 'unknown' END"


#: The groups of chunks that are similar to the very same chunks, ten or more.
_CLIQUES = """
    WITH v AS (SELECT chunk_id, any_value(list_transform(vector, lambda x: x::DOUBLE)) AS v FROM chunk_vectors WHERE vector IS NOT NULL GROUP BY chunk_id),
    u AS (SELECT chunk_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM v WHERE list_dot_product(v, v) > 0),
    e AS (SELECT a.chunk_id AS a, b.chunk_id AS b FROM u a, u b WHERE list_dot_product(a.v, b.v) >= 0.85),
    g AS (SELECT a, list_sort(list(b)) AS members FROM e GROUP BY a HAVING count(*) >= 10)
"""

#: The cases of problem 3 are those of a length, which SQL states; its pieces are tested by round trips. Problems 4, 6 and 9 are
#: stated over all pairs, which SQL can do on small tables only.
SQL: dict[str, str] = {
    "p3_found": """
        SELECT DISTINCT 'corpus' AS table_name, id AS item_key FROM corpus WHERE length(text) > 4000 AND id IS NOT NULL
        UNION ALL
        SELECT DISTINCT 'metadata', chunk_id FROM metadata WHERE length(text) > 2000 AND chunk_id IS NOT NULL
    """,
    "p3_rebuilt": """
        SELECT DISTINCT 'corpus' AS table_name, id AS item_key, true AS kept, true AS all_there, md5(text) AS text_md5 FROM corpus WHERE length(text) > 4000 AND id IS NOT NULL
        UNION ALL
        SELECT DISTINCT 'metadata', chunk_id, true, true, md5(text) FROM metadata WHERE length(text) > 2000 AND chunk_id IS NOT NULL
    """,
    "p4_found": f"""
        WITH s AS MATERIALIZED {_grams("corpus", "id", 3)}, n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
        c AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
        SELECT id_a, id_b FROM c JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE 2 * c >= x.n + y.n - c
    """,
    "p4_links": f"""
        WITH s AS MATERIALIZED {_grams("corpus", "id", 5)}, n AS (SELECT id, count(*) AS n FROM s WHERE id IS NOT NULL GROUP BY id),
        c AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
        l AS (SELECT id_a AS id, count(*) AS links FROM c JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE c >= 0.8 * (x.n + y.n - c) GROUP BY id_a)
        SELECT id, coalesce(links, 0) AS links FROM n LEFT JOIN l USING (id)
    """,
    "p5_token_budget": _tokens("corpus", "id") + rf""",
        named AS (SELECT id, {_slug("source")} AS source, {_slug("tradition")} AS tradition, {_language("language")} AS language FROM corpus WHERE id IS NOT NULL),
        per_id AS (SELECT sizes.id, n_tokens, any_value(source) AS source, any_value(tradition) AS tradition, any_value(language) AS language FROM sizes JOIN named ON named.id = sizes.id GROUP BY ALL)
        SELECT CASE WHEN grouping(source) = 1 THEN '(all)' ELSE source END AS source, CASE WHEN grouping(tradition) = 1 THEN '(all)' ELSE tradition END AS tradition,
        CASE WHEN grouping(language) = 1 THEN '(all)' ELSE language END AS language, count(*)::BIGINT AS documents, sum(n_tokens)::BIGINT AS tokens
        FROM per_id GROUP BY CUBE (source, tradition, language)
    """,
    "p5_documents": _tokens("corpus", "id") + "SELECT id, n_tokens FROM sizes",
    "p6_found": _CLIQUES + "SELECT x.a AS chunk_id_a, y.a AS chunk_id_b FROM g x JOIN g y ON x.members = y.members AND x.a < y.a",
    "p6_members": _CLIQUES + """
        , m AS (SELECT a, members[1] AS least_chunk, count(*) OVER (PARTITION BY members)::INT AS n, len(members) AS size FROM g)
        SELECT chunk_id, least_chunk, coalesce(n, 0)::INT AS size FROM (SELECT DISTINCT chunk_id FROM metadata WHERE chunk_id IS NOT NULL)
        LEFT JOIN (SELECT * FROM m WHERE n = size) ON chunk_id = a
    """,
    "p7_counts": rf"""
        SELECT id, len({_WORDS})::BIGINT AS n_words, length(regexp_replace(text, '[{_SPACE}]', '', 'g'))::BIGINT AS n_chars,
        len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')))::BIGINT AS n_lines
        FROM (SELECT id, any_value(text) AS text FROM corpus WHERE id IS NOT NULL AND regexp_matches(text, '[^{_SPACE}]') GROUP BY id)
    """,
    "p8_found": _tokens("documents", "doc_id") + "SELECT doc_id FROM sizes WHERE n_tokens > 1024",
    "p8_checked": _tokens("documents", "doc_id") + "SELECT doc_id, n_tokens, true AS fits, true AS whole FROM sizes WHERE n_tokens > 0",
    "p9_found": f"SELECT DISTINCT doc_id, item_id FROM {_grams('documents', 'doc_id', 12)} d JOIN {_grams('eval_items', 'item_id', 12)} e USING (g)",
}
