"""Queries: near duplicates and repeated passages."""

from __future__ import annotations

from corpuskit.llm import bag_minhash, cross_polytope, relative_lz
from corpuskit.llm.common import table
from corpuskit.llm.registry import query

# the smallest id that each id of ``links(a, b)`` (both ways) reaches
_REACH = """reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

#: Every pair of documents with a shingle in common, by overlap of the multisets; ids are taken to be distinct.
NEAR_SQL = f"""
WITH RECURSIVE
     w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
     grams AS (SELECT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) t(i)),
     bags AS (SELECT doc_id, g, count(*) AS n FROM grams GROUP BY doc_id, g),
     sizes AS (SELECT doc_id, sum(n) AS n FROM bags GROUP BY doc_id),
     meets AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS shared
               FROM bags x JOIN bags y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
     pairs AS (SELECT a, b FROM meets JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
               WHERE 10 * shared >= 8 * (s.n + t.n - shared)),
     links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
     {_REACH},
     least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(b, doc_id)) AS class_id, doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM documents LEFT JOIN least_ ON doc_id = a
"""

#: Every window of 20 words by its words; ids are taken to be distinct.
REPEATS_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
     windows AS (SELECT doc_id, i AS start, array_to_string(ws[i:i + 19], ' ') AS run
                 FROM w, unnest(range(1, greatest(len(ws) - 18, 1))) t(i)),
     placed AS (SELECT doc_id, start, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS LAST, start) AS nth FROM windows),
     gone AS (SELECT DISTINCT doc_id, start + j AS spot FROM placed, unnest(range(0, 20)) t(j) WHERE nth > 1),
     lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
     words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS spot FROM w),
     left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS body
               FROM words ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN left_ USING (doc_id)
"""

#: Every pair of vectors by its cosine; ids are taken to be distinct.
VECTORS_SQL = f"""
WITH RECURSIVE
     v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
               WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
     {_REACH},
     least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
     counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(l.b, vec_id)) AS kept
FROM embeddings LEFT JOIN least_ l ON vec_id = l.a LEFT JOIN counted c ON vec_id = c.a
"""


@query("op5_bag_minhash", NEAR_SQL)
def op5_bag_minhash(spark, sf_dir):
    """Every document with its class id (the smallest of the class) and whether it stays."""
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


@query("op4_relative_lz", REPEATS_SQL)
def op4_relative_lz(spark, sf_dir):
    """Every document after the removal of words in windows of 20 that start earlier elsewhere."""
    return relative_lz.remove_repeats(table(spark, sf_dir, "documents"), spans=False).drop("factors")


@query("op6_cross_polytope", VECTORS_SQL)
def op6_cross_polytope(spark, sf_dir):
    """Every vector with its links, its component and whether it stays."""
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))
