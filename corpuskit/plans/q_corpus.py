"""Driver queries for vocabularies and the corpus model (E, F) and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit import fields as FD
from corpuskit.fields import Fields, LANGUAGE_REMAPPED
from corpuskit.functions import predicates as P
from corpuskit.operators import corpus as C
from corpuskit.operators import vocab as V
from corpuskit.plans import jobs as J
from corpuskit.plans.oracle_views import HIER, REC, with_
from corpuskit.plans.registry import query
from corpuskit.sources import fixtures as FX
from corpuskit.sources.records import read_vocabulary

TAXON = Fields.TAXONID.value
LANG = Fields.LANGUAGE.value


def nodes(spark, sf):
    return V.concept_nodes(read_vocabulary(spark, FX.hier_file(spark, sf), multiline=False))


def rec_corpus(spark, sf, targets=(TAXON,), **kw) -> C.Corpus:
    """K1 over the record view: taxon target, labels from the staged source vocabulary."""
    return J.base_corpus(FX.rec_docs(spark, sf), targets,
                         labels={TAXON: FX.source_labels(spark, sf)},
                         dropped_values={TAXON: {""}}, **kw)


# --- E: vocabularies -------------------------------------------------------------

WH = with_(HIER)


@query("voc_children", WH + """
SELECT DISTINCT 'root' AS id, rid AS child FROM hn
UNION SELECT DISTINCT rid, nid FROM hn
UNION SELECT DISTINCT nid, cid FROM hn
UNION SELECT DISTINCT cid, NULL FROM hn""")
def voc_children(spark, sf):
    return V.children_map(nodes(spark, sf))


@query("voc_parents", WH + "SELECT id, parent FROM hparents")
def voc_parents(spark, sf):
    return V.parent_map(nodes(spark, sf))


@query("voc_labels", WH + "SELECT id, label FROM hlabels")
def voc_labels(spark, sf):
    return V.label_table(nodes(spark, sf))


@query("label_single", WH + """
SELECT o.o_orderkey, l.label FROM orders o
LEFT JOIN hlabels l ON l.id = 'c' || CAST(o.o_custkey AS VARCHAR)""")
def label_single(spark, sf):
    o = FX.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("cid"))
    return V.labels_for_ids(o, "cid", V.label_table(nodes(spark, sf))).select("o_orderkey", "label")


@query("label_multi", WH + """
SELECT o.o_orderkey,
       coalesce(l1.label, '<null>') || '|' || coalesce(l2.label, '<null>') || '|<null>' AS labels
FROM orders o
LEFT JOIN hlabels l1 ON l1.id = 'c' || CAST(o.o_custkey AS VARCHAR)
LEFT JOIN hlabels l2 ON l2.id = 'n' || CAST(o.o_custkey % 25 AS VARCHAR)""")
def label_multi(spark, sf):
    o = FX.table(spark, sf, "orders")
    ids = F.array(F.concat(F.lit("c"), F.col("o_custkey").cast("string")),
                  F.concat(F.lit("n"), (F.col("o_custkey") % 25).cast("string")),
                  F.concat(F.lit("x"), (F.col("o_orderkey") % 7).cast("string")))
    rows = o.select("o_orderkey", ids.alias("ids"))
    out = V.labels_for_ids(rows, "ids", V.label_table(nodes(spark, sf)), "labels", key="o_orderkey")
    return out.select("o_orderkey", F.array_join("labels", "|", "<null>").alias("labels"))


@query("label_by_uri", """
SELECT p_partkey, CASE WHEN p_brand LIKE '%3' THEN NULL ELSE p_brand END AS label FROM part""")
def label_by_uri(spark, sf):
    part = FX.table(spark, sf, "part")
    suffix = F.when(F.col("p_partkey") % 3 == 0, ".html").when(F.col("p_partkey") % 3 == 1, ".json") \
        .otherwise("")
    rows = part.select("p_partkey", F.concat(F.lit(FX.URI_PREFIX), "p_brand", suffix).alias("uri"))
    return V.labels_by_uri(rows, "uri", FX.uri_labels(spark, sf)).select("p_partkey", "label")


@query("voc_hierarchy", WH + """
SELECT l.label AS name, l.id AS key, p.parent FROM hlabels l LEFT JOIN hparents p ON p.id = l.id""")
def voc_hierarchy(spark, sf):
    return V.hierarchy(nodes(spark, sf))


LRT = Fields.LRT.value


@query("voc_registry", WH + f"""
SELECT '{TAXON}' AS field, id AS uri, label FROM hlabels
UNION ALL SELECT DISTINCT '{LRT}', 'http://x/' || p_brand, p_brand FROM part WHERE p_brand NOT LIKE '%3'""")
def voc_registry(spark, sf):
    """Two vocabularies in one walk; the other entries of the default registry are left out."""
    overrides = dict.fromkeys(FD.default_vocabularies()) | {TAXON: FX.hier_file(spark, sf), LRT: FX.brand_vocabulary_file(spark, sf)}
    return J.vocabulary_labels(spark, "", overrides=overrides, multiline=False)


# --- F: corpus ----------------------------------------------------------------------

RCORPUS = r"""
rassign AS (
  SELECT DISTINCT 'properties.ccm:taxonid' AS field, id AS doc_id, x AS uri
  FROM (SELECT id, unnest(taxon) AS x FROM rec) WHERE x IS NULL OR x <> ''
),
rcats AS (
  SELECT field, CAST(row_number() OVER (PARTITION BY field ORDER BY uri ASC NULLS FIRST) - 1 AS INTEGER) AS idx,
         uri, CASE WHEN uri LIKE 'http://x/t/src%' THEN upper(substring(uri, 12)) END AS label
  FROM (SELECT DISTINCT field, uri FROM rassign)
),
rsupport AS (
  SELECT c.field, c.idx, c.uri, c.label, count(a.doc_id) AS support
  FROM rcats c LEFT JOIN rassign a ON a.uri IS NOT DISTINCT FROM c.uri
  GROUP BY c.field, c.idx, c.uri, c.label
)"""
WR = with_(REC, RCORPUS)


def _rerank(where: str, cols: str = "field, idx, uri") -> str:
    return WR + f"""
SELECT {cols.replace('idx', 'CAST(row_number() OVER (PARTITION BY field ORDER BY idx) - 1 AS INTEGER) AS idx')}
FROM rsupport WHERE {where}"""


@query("encode_long", WR + "SELECT field, doc_id, uri FROM rassign")
def encode_long(spark, sf):
    return rec_corpus(spark, sf).assignments


@query("encode_bits", WR + """
SELECT r.id AS doc_id, string_agg(CASE WHEN a.doc_id IS NOT NULL THEN '1' ELSE '0' END, '' ORDER BY c.idx) AS bits
FROM rec r CROSS JOIN rcats c
LEFT JOIN rassign a ON a.doc_id = r.id AND a.uri IS NOT DISTINCT FROM c.uri
GROUP BY r.id""")
def encode_bits(spark, sf):
    return C.bit_strings(rec_corpus(spark, sf), TAXON)


@query("target_build", WR + "SELECT field, idx, uri, label FROM rcats")
def target_build(spark, sf):
    return rec_corpus(spark, sf).categories


@query("target_registry", WR + "SELECT field, idx, uri, label FROM rcats")
def target_registry(spark, sf):
    """K1 with labels by default: from the vocabulary that the catalogue's registry names, staged in a folder."""
    root = FX.staged_vocabularies(spark, sf, FD.default_vocabularies()[TAXON])
    return J.base_corpus(FX.rec_docs(spark, sf), [TAXON], dropped_values={TAXON: {""}}, vocabulary_root=root).categories


@query("support", WR + "SELECT field, idx, uri, label, support FROM rsupport")
def support_q(spark, sf):
    return C.support(rec_corpus(spark, sf))


@query("labels_per_doc", WR + """
SELECT r.id AS doc_id, count(a.uri) + count(CASE WHEN a.doc_id IS NOT NULL AND a.uri IS NULL THEN 1 END) AS n
FROM rec r LEFT JOIN rassign a ON a.doc_id = r.id GROUP BY r.id""")
def labels_per_doc(spark, sf):
    return C.labels_per_doc(rec_corpus(spark, sf), TAXON)


@query("subset_docs", WR + """
SELECT field, doc_id, uri FROM rassign WHERE doc_id IN (SELECT id FROM rec WHERE quality = 1)""")
def subset_docs(spark, sf):
    c = rec_corpus(spark, sf)
    keep = FX.table(spark, sf, "labels").where("quality = 1") \
        .select(F.col("doc_id").cast("string").alias("doc_id"))
    return C.subset_docs(c, keep).assignments


@query("subset_categories", _rerank("idx % 2 = 0"))
def subset_categories(spark, sf):
    c = rec_corpus(spark, sf)
    keep = c.categories.where(F.col("idx") % 2 == 0).select("uri")
    return C.subset_categories(c, TAXON, keep).categories.select("field", "idx", "uri")


@query("drop_unlabelled", _rerank("label IS NOT NULL", "field, idx, uri, label"))
def drop_unlabelled(spark, sf):
    return C.drop_unlabelled(rec_corpus(spark, sf), TAXON).categories


@query("drop_low_support", _rerank("support >= 60"))
def drop_low_support(spark, sf):
    return C.drop_low_support(rec_corpus(spark, sf), TAXON, 60).categories.select("field", "idx", "uri")


@query("drop_unassigned", WR + """
SELECT DISTINCT a.doc_id FROM rassign a JOIN rsupport s ON a.uri IS NOT DISTINCT FROM s.uri
WHERE s.support >= 60""")
def drop_unassigned(spark, sf):
    c = C.drop_low_support(rec_corpus(spark, sf), TAXON, 60)
    return C.drop_unassigned(c).docs.select("doc_id")


@query("categories_in_set", _rerank(
    "uri IN (SELECT 'http://x/t/' || source FROM documents WHERE n_chars > 5000)"))
def categories_in_set(spark, sf):
    ids = FX.table(spark, sf, "documents").where("n_chars > 5000") \
        .select(F.concat(F.lit(FX.TAXON_PREFIX), "source").alias("uri"))
    return C.categories_in_set(rec_corpus(spark, sf), TAXON, ids).categories.select("field", "idx", "uri")


@query("docs_with_label", with_(REC, HIER) + """
SELECT id AS doc_id FROM rec WHERE 'c' || id IN (SELECT id FROM hlabels)""")
def docs_with_label(spark, sf):
    labels = V.label_lookup_table(nodes(spark, sf))
    return C.docs_with_label(rec_corpus(spark, sf), "c", labels).docs.select("doc_id")


# --- flagship: repaired, filtered records -> category support -------------------------

FLAGSHIP_SQL = with_(REC, r"""
fdocs AS (SELECT * FROM rec WHERE lang IN ('de', 'en') AND coalesce(length(title), 0) >= 1 AND has_descr)""",
                     r"""
fassign AS (
  SELECT DISTINCT 'properties.ccm:taxonid' AS field, id AS doc_id, x AS uri
  FROM (SELECT id, unnest(taxon) AS x FROM fdocs) WHERE x IS NULL OR x <> ''
)""") + """
SELECT field, CAST(row_number() OVER (PARTITION BY field ORDER BY uri ASC NULLS FIRST) - 1 AS INTEGER) AS idx,
       uri, CASE WHEN uri LIKE 'http://x/t/src%' THEN upper(substring(uri, 12)) END AS label,
       count(*) AS support
FROM fassign GROUP BY field, uri"""


@query("flagship_support", FLAGSHIP_SQL)
def flagship_support(spark, sf):
    """Minimum slice: scan -> repair language codes -> language and text filters ->
    taxon target -> encode -> support per category."""
    c = J.base_corpus(FX.rec_docs(spark, sf), [TAXON], labels={TAXON: FX.source_labels(spark, sf)},
                      filters=[P.language_filter(["de", "en"]), P.existing_text_filter],
                      dropped_values={TAXON: {""}}, remapped_values={LANG: LANGUAGE_REMAPPED})
    return C.support(c)
