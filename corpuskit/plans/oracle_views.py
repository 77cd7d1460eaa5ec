r"""Relational twins of the fixture views, for the DuckDB oracles.

The Spark side builds VARIANT records and walks them with the path compiler; the
oracles never see records. They restate each record rule as columns of ``rec``
(one row per document) and answer every query from those columns, so a match
checks the whole VARIANT path: JSON build, scan, walk, repair, predicate.
"""

REC = r"""
rec AS (
  SELECT d.doc_id AS d, CAST(d.doc_id AS VARCHAR) AS id, d.text, d.lang, d.source, d.n_chars,
    CASE WHEN d.doc_id % 10 = 0 THEN 'archive' ELSE 'workspace' END AS proto,
    CASE WHEN d.doc_id % 17 = 0 THEN 'ccm:map' ELSE 'ccm:io' END AS typ,
    CASE WHEN d.doc_id % 19 = 0 THEN 'other' ELSE 'mds_oeh' END AS mds,
    CAST(d.doc_id % 3 AS INTEGER) AS asp,
    CASE WHEN d.doc_id % 23 = 0 THEN NULL ELSE substring(d.text, 1, 40) END AS title,
    d.doc_id % 11 <> 0 AS has_descr,
    CASE WHEN d.doc_id % 5 = 0 THEN
      CASE d.lang WHEN 'de' THEN 'de_DE' WHEN 'en' THEN 'en_US' WHEN 'es' THEN 'es_ES'
                  WHEN 'fr' THEN 'fr_FR' ELSE d.lang END
      ELSE d.lang END AS lang_code,
    d.doc_id % 2 = 1 AS lang_list,
    d.doc_id % 2 = 1 AND d.doc_id % 7 = 0 AS lang_two,
    list_concat(list_concat(list_concat(['http://x/t/' || d.source],
      CASE WHEN d.doc_id % 4 = 3 THEN ['http://x/t/' || d.lang] ELSE []::VARCHAR[] END),
      CASE WHEN d.doc_id % 13 = 0 THEN [''] ELSE []::VARCHAR[] END),
      CASE WHEN d.doc_id % 29 = 0 THEN [NULL::VARCHAR] ELSE []::VARCHAR[] END) AS taxon,
    d.doc_id % 6 = 0 AS in_test,
    d.doc_id % 4 = 0 AS perm_public,
    d.doc_id % 4 = 1 AS coll_public,
    CASE WHEN d.doc_id % 5 = 2 THEN 'Redaktionsbuffet' ELSE d.source END AS coll_title,
    d.doc_id % 3 = 0 AS coll_two,
    l.quality
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

# catalogue / visibility / text conditions on rec
CATALOGUE = "(proto = 'workspace' AND typ = 'ccm:io' AND mds = 'mds_oeh' AND asp <> 2)"
PUBLIC = "(perm_public OR coll_public)"
HAS_TEXT = "(coalesce(length(title), 0) >= 1 AND has_descr)"

TOK = r"""
tok AS (
  SELECT doc_id, CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS pos, unnest(ws) AS word
  FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM documents)
)"""

# the text corpus: every document, categories = source plus language when doc_id % 4 = 3
TEXT_ASSIGN = r"""
tassign AS (
  SELECT 'topic' AS field, CAST(doc_id AS VARCHAR) AS doc_id, source AS uri FROM documents
  UNION ALL
  SELECT 'topic', CAST(doc_id AS VARCHAR), lang FROM documents WHERE doc_id % 4 = 3
)"""

# brand corpus over orders
BRAND = r"""
ab AS (
  SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) AS doc_id, p.p_brand AS uri
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
bdocs AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS k FROM orders),
bcats AS (
  SELECT CAST(row_number() OVER (ORDER BY uri ASC NULLS FIRST) - 1 AS INTEGER) AS idx, uri,
         CASE WHEN uri LIKE '%3' THEN NULL ELSE uri END AS label
  FROM (SELECT DISTINCT uri FROM ab)
)"""

# vocabulary fragments region -> nation -> customer
HIER = r"""
hn AS (
  SELECT 'c' || CAST(c.c_custkey AS VARCHAR) AS cid, c.c_name,
         'n' || CAST(n.n_nationkey AS VARCHAR) AS nid, n.n_name,
         'r' || CAST(r.r_regionkey AS VARCHAR) AS rid, r.r_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey
),
hlabels AS (
  SELECT DISTINCT cid AS id, c_name AS label FROM hn
  UNION SELECT DISTINCT nid, n_name FROM hn
  UNION SELECT DISTINCT rid, r_name FROM hn
),
hparents AS (
  SELECT DISTINCT cid AS id, nid AS parent FROM hn
  UNION SELECT DISTINCT nid, rid FROM hn
  UNION SELECT DISTINCT rid, 'root' FROM hn
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
