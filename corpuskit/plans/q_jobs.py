"""Driver queries for the end-to-end jobs (K) and the published CSV triple."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.fields import Fields
from corpuskit.operators import text as T
from corpuskit.plans import jobs as J
from corpuskit.plans.oracle_views import CATALOGUE, HAS_TEXT, PUBLIC, REC, TOK, with_
from corpuskit.plans.q_corpus import RCORPUS, rec_corpus
from corpuskit.plans.q_order import GREEDY, SPLIT
from corpuskit.plans.q_text import EXCLUDED_WORD, VOTE, prune_ctes, text_corpus
from corpuskit.plans.registry import query
from corpuskit.sources import fixtures as FX
from corpuskit.sources import published as PUB
from corpuskit.session import staging_path

TAXON = Fields.TAXONID.value
RAW = "coalesce(title, '') || chr(10) || CASE WHEN has_descr THEN text ELSE '' END"


def _doc_summary(c):
    n = c.assignments.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_assign"))
    return (c.docs.join(n, "doc_id", "left")
            .select("doc_id", F.md5("raw_text").alias("text_md5"), "editor",
                    F.coalesce(F.array_contains("test_fields", TAXON), F.lit(False)).alias("in_test"),
                    F.coalesce("n_assign", F.lit(0)).cast("long").alias("n_assign")))


def _doc_sql(where: str, n_assign: str) -> str:
    return with_(REC) + f"""
SELECT id AS doc_id, md5({RAW}) AS text_md5, coll_title = 'Redaktionsbuffet' AS editor, in_test,
       CAST({n_assign} AS BIGINT) AS n_assign
FROM rec WHERE {where}"""


@query("job_base", _doc_sql("true", "len(taxon)"))
def job_base(spark, sf):
    c = J.base_corpus(FX.rec_docs(spark, sf), [TAXON], labels={TAXON: FX.source_labels(spark, sf)})
    return _doc_summary(c)


@query("job_flat", _doc_sql(f"{CATALOGUE} AND {PUBLIC} AND {HAS_TEXT}",
                            "len(list_filter(taxon, lambda x: x IS NULL OR x <> ''))"))
def job_flat(spark, sf):
    c = J.flat_corpus(FX.rec_docs(spark, sf), [TAXON], labels={TAXON: FX.source_labels(spark, sf)})
    return _doc_summary(c)


@query("job_collections", _doc_sql("asp = 2", "len(taxon)"))
def job_collections(spark, sf):
    c = J.collections_corpus(FX.rec_docs(spark, sf), [TAXON])
    return _doc_summary(c)


# --- A6 / A7 -------------------------------------------------------------------------

@query("publish_data", with_(REC, RCORPUS) + f"""
SELECT r.id AS uuid, {RAW.replace('title', 'r.title').replace('has_descr', 'r.has_descr').replace('THEN text', 'THEN r.text')} AS text,
       CAST(CASE WHEN r.coll_title = 'Redaktionsbuffet' THEN 1 ELSE 0 END AS INTEGER) AS editorially_confirmed,
       string_agg(CASE WHEN a.doc_id IS NOT NULL THEN '1' ELSE '0' END, '' ORDER BY c.idx) AS "properties.ccm:taxonid",
       CAST(CASE WHEN r.in_test THEN 1 ELSE 0 END AS INTEGER) AS "properties.ccm:taxonid_test-set"
FROM rec r CROSS JOIN rcats c
LEFT JOIN rassign a ON a.doc_id = r.id AND a.uri IS NOT DISTINCT FROM c.uri
GROUP BY r.id, r.title, r.has_descr, r.text, r.coll_title, r.in_test""")
def publish_data(spark, sf):
    return PUB.data_frame(rec_corpus(spark, sf))


@query("publish_metadata", with_(REC, RCORPUS) + "SELECT field, idx AS index, uri, label FROM rcats")
def publish_metadata(spark, sf):
    return PUB.metadata_frame(rec_corpus(spark, sf))


@query("publish_tokens", with_(TOK, VOTE) + r"""
SELECT CAST(d.doc_id AS VARCHAR) AS uuid,
       CASE WHEN len(ws) = 0 THEN '[]' ELSE '["' || array_to_string(ws, '","') || '"]' END AS processed_text,
       b.lang AS language
FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM documents) d
LEFT JOIN best b ON b.doc_id = d.doc_id""")
def publish_tokens(spark, sf):
    c = text_corpus(spark, sf)
    return PUB.tokens_frame(c.with_(docs=T.language_vote(c.docs)))


@query("import_published", with_(REC, RCORPUS) + "SELECT field, doc_id, uri FROM rassign")
def import_published(spark, sf):
    c = rec_corpus(spark, sf)
    target = staging_path(spark, "published", unique=True)
    paths = PUB.publish(c, target, "corpus")
    back = PUB.import_published(spark, paths["data"], paths["metadata"])
    return back.assignments


# --- K4 - K7 ---------------------------------------------------------

def _training(spark, sf):
    return J.training_corpus(FX.rec_docs(spark, sf), [TAXON], language="en",
                             labels={TAXON: FX.source_labels(spark, sf)})


# the training job's steps, one after the other
TRAINING = [REC, rf"""
flat AS (SELECT *, {RAW} AS raw FROM rec WHERE {CATALOGUE} AND {PUBLIC} AND {HAS_TEXT} AND length(title) >= 30)""", r"""
tok AS (SELECT doc_id, CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS pos, unnest(ws) AS word
        FROM (SELECT id AS doc_id, regexp_extract_all(raw, '[\p{L}\p{N}]+') AS ws FROM flat))""", VOTE, f"""
runs AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM (
           SELECT doc_id, pos, word, CASE WHEN lag(word) OVER (PARTITION BY doc_id ORDER BY pos) IS DISTINCT FROM word THEN 1 ELSE 0 END AS nw
           FROM tok)),
short AS (SELECT doc_id, pos, word FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS len,
                                                pos - min(pos) OVER (PARTITION BY doc_id, run) AS rk FROM runs)
          WHERE (len < 4 OR rk < 2) AND NOT {EXCLUDED_WORD}),
dfs AS (SELECT word, count(DISTINCT doc_id) AS df FROM short GROUP BY word),
in_rate AS (SELECT s.* FROM short s JOIN dfs USING (word) WHERE df >= 10 AND df <= 0.25 * (SELECT count(*) FROM flat)),
alldocs AS (SELECT id AS doc_id FROM flat JOIN best ON best.doc_id = id WHERE best.lang = 'en'),
b0 AS (SELECT doc_id, word, CAST(count(*) AS INTEGER) AS n FROM in_rate WHERE length(word) <= 30
         AND doc_id IN (SELECT doc_id FROM alldocs) GROUP BY doc_id, word),
labelled AS (SELECT DISTINCT '{TAXON}' AS field, id AS doc_id, x AS uri FROM (SELECT id, unnest(taxon) AS x FROM flat) WHERE x LIKE 'http://x/t/src%'),
k0 AS (SELECT DISTINCT field, uri FROM labelled),
a0 AS (SELECT * FROM labelled WHERE doc_id IN (SELECT doc_id FROM alldocs))""", *prune_ctes(10, 5, 10)]


@query("job_training", with_(*TRAINING) + """
SELECT f.doc_id, r.coll_title = 'Redaktionsbuffet' AS editor, CAST(l AS BIGINT) AS length,
       row_number() OVER (ORDER BY r.coll_title = 'Redaktionsbuffet' DESC, f.doc_id) - 1 AS ord
FROM final_docs f JOIN rec r ON r.id = f.doc_id
LEFT JOIN (SELECT doc_id, sum(n) AS l FROM final_b GROUP BY doc_id) x ON x.doc_id = f.doc_id""")
def job_training(spark, sf):
    c, order = _training(spark, sf)
    lens = c.bow.groupBy("doc_id").agg(F.sum("n").cast("long").alias("length"))
    return order.join(lens, "doc_id", "left").select("doc_id", "editor", "ord", "length")


def _candidates(spark, sf):
    """Collections are the records themselves here: each record's collection ids name other records."""
    return J.candidates_corpus(FX.rec_docs(spark, sf), TAXON, topic_labels=FX.topic_labels(spark, sf),
                               topic_prefix=FX.TAXON_PREFIX, length_unit="chars")


CANDIDATES = rf"""
flat AS (SELECT *, {RAW} AS raw FROM rec WHERE {CATALOGUE} AND {PUBLIC} AND {HAS_TEXT}
         AND length(text) >= 50),
toks AS (SELECT *, flatten(list_filter(list_transform(string_split_regex(raw, '[.!?
]+'),
                                                       lambda s: regexp_extract_all(s, '[\p{{L}}\p{{N}}]+')),
                                        lambda x: len(x) >= 6)) AS t FROM flat),
topics AS (SELECT id FROM rec WHERE asp = 2 AND (d // 30) % 2 = 0),
cand AS (SELECT id AS doc_id, d, taxon, CAST(len(t) AS INTEGER) AS n_tokens,
                CAST(CASE WHEN CAST(d - d % 30 + 2 AS VARCHAR) IN (SELECT id FROM topics) THEN 1 ELSE 0 END AS BIGINT) AS n
         FROM toks WHERE len(t) >= 20),
queue_order AS (SELECT *, row_number() OVER (ORDER BY n_tokens DESC, n ASC, doc_id ASC) - 1 AS ord FROM cand)"""


@query("job_candidates", with_(REC, CANDIDATES) + "SELECT doc_id, n_tokens, n, ord FROM queue_order")
def job_candidates(spark, sf):
    _, order = _candidates(spark, sf)
    return order


PUBLISHED_PARTS = ["ab AS (SELECT doc_id, uri FROM final_a)", "bdocs AS (SELECT doc_id FROM final_docs)",
                   "bcats AS (SELECT DISTINCT uri FROM final_a)", SPLIT, GREEDY]


@query("job_publish", with_(*TRAINING, *PUBLISHED_PARTS) + """
SELECT doc_id AS uuid, CASE WHEN doc_id IN (SELECT doc_id FROM kept) THEN 'test' ELSE 'train' END AS part FROM bdocs""")
def job_publish(spark, sf):
    """K6: training corpus -> balanced split -> two published triples; returns the data files."""
    c, order = _training(spark, sf)
    p_train, p_test = J.publish_job(c, order, TAXON, staging_path(spark, "published", unique=True))
    read = lambda p: spark.read.options(header="true", multiLine="true", escape='"').csv(p)
    return (read(p_train["data"]).select("uuid", F.lit("train").alias("part"))
            .unionByName(read(p_test["data"]).select("uuid", F.lit("test").alias("part"))))


REVIEW = """
uris AS (SELECT id, unnest(list_distinct(list_transform(list_filter(taxon, lambda x: x IS NULL OR x <> ''),
                                                        lambda x: coalesce(x, '~')))) AS u FROM flat),
cats AS (SELECT u, CAST(row_number() OVER (ORDER BY CASE WHEN u = '~' THEN 0 ELSE 1 END, u) - 1 AS INTEGER) AS idx
         FROM (SELECT DISTINCT u FROM uris)),
asg AS (SELECT q.doc_id, q.ord, c.idx, nullif(c.u, '~') AS uri FROM queue_order q JOIN uris x ON x.id = q.doc_id JOIN cats c ON c.u = x.u),
first_round AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY ord) AS r FROM asg) WHERE r <= 5),
visited AS (SELECT DISTINCT doc_id FROM first_round),
acc AS (SELECT c.idx, count(a.doc_id) AS accepted FROM cats c
        LEFT JOIN (SELECT * FROM asg WHERE doc_id IN (SELECT doc_id FROM visited WHERE CAST(doc_id AS BIGINT) % 2 = 0)) a ON a.idx = c.idx
        GROUP BY c.idx)"""


@query("job_review", with_(REC, CANDIDATES, REVIEW) + """
SELECT doc_id, uri, idx, ord, rank FROM (
  SELECT a.*, acc.accepted, row_number() OVER (PARTITION BY a.idx ORDER BY ord) AS rank
  FROM asg a JOIN acc ON acc.idx = a.idx WHERE doc_id NOT IN (SELECT doc_id FROM visited) AND accepted < 5)
WHERE rank <= 5 - accepted""")
def job_review(spark, sf):
    """K7: field discovery, then two rounds of review; the first round's queue is visited, every other document of it accepted."""
    state = staging_path(spark, "review", unique=True)
    queue, _ = J.review_session(FX.rec_docs(spark, sf), "doc_id", TAXON, FX.topic_labels(spark, sf), state, 5,
                                topic_prefix=FX.TAXON_PREFIX, length_unit="chars")
    c, order = _candidates(spark, sf)
    seen = queue.select("doc_id").distinct()
    J.record_review(spark, state, seen, seen.where(F.col("doc_id").cast("long") % 2 == 0))
    queue, _ = J.review_job(c, order, TAXON, state, 5)
    return queue.select("doc_id", "uri", "idx", "ord", F.col("rank").cast("long").alias("rank"))
