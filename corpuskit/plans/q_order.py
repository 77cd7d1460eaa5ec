"""Driver queries for ordering and review (H), splitting (I) and evaluation (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.fields import Fields
from corpuskit.operators import corpus as C
from corpuskit.operators import order as O
from corpuskit.operators import report as R
from corpuskit.operators import split as S
from corpuskit.operators import text as T
from corpuskit.operators.ordinal import with_ordinal
from corpuskit.plans.oracle_views import BRAND, REC, with_
from corpuskit.plans.q_corpus import RCORPUS, rec_corpus
from corpuskit.plans.registry import query
from corpuskit.sources import fixtures as FX

def empty():
    return F.array().cast("array<string>")
COLL = Fields.COLLECTIONS_UUID.value


def brand_corpus(spark, sf) -> C.Corpus:
    """Orders as documents, their distinct part brands as a 25-category target."""
    orders = FX.table(spark, sf, "orders")
    docs = orders.select(F.col("o_orderkey").cast("string").alias("doc_id"), F.lit("").alias("raw_text"),
                         F.lit(False).alias("editor"), empty().alias("test_fields"))
    a = FX.assign_brand(spark, sf).select(F.lit("brand").alias("field"), "doc_id", "uri")
    labels = FX.uri_labels(spark, sf).select(F.col("label").alias("uri"), "label")
    cats = C.attach_labels(C.category_index(a.select("field", "uri").distinct()), labels)
    return C.Corpus(docs=docs, assignments=a, categories=cats, fields=("brand",))


def brand_positions(spark, sf):
    o = FX.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"),
                                             "o_orderkey")
    return with_ordinal(o, ["o_orderkey"], "ord").select("doc_id", "ord")


# --- H -----------------------------------------------------------------------------

@query("sort_editor", with_(REC) + """
SELECT id AS doc_id, coll_title = 'Redaktionsbuffet' AS editor,
       row_number() OVER (ORDER BY coll_title = 'Redaktionsbuffet' DESC, id ASC) - 1 AS ord FROM rec""")
def sort_editor(spark, sf):
    return O.sort_editor(rec_corpus(spark, sf))


COLL_N = """
coll_n AS (SELECT id AS doc_id, CAST(CASE WHEN coll_two THEN 3 ELSE 2 END AS BIGINT) AS n FROM rec)"""


@query("sort_collections", with_(REC, COLL_N) + """
SELECT doc_id, n, row_number() OVER (ORDER BY n DESC, doc_id ASC) - 1 AS ord FROM coll_n""")
def sort_collections(spark, sf):
    return O.sort_collections(rec_corpus(spark, sf, targets=(COLL,)), COLL)


@query("sort_len", with_(REC, COLL_N) + r"""
SELECT doc_id, n_tokens, n, row_number() OVER (ORDER BY n_tokens DESC, n ASC, doc_id ASC) - 1 AS ord
FROM (SELECT c.doc_id, c.n,
             CAST(len(regexp_extract_all(coalesce(r.title, '') || chr(10) ||
                  CASE WHEN r.has_descr THEN r.text ELSE '' END, '[\p{L}\p{N}]+')) AS BIGINT) AS n_tokens
      FROM coll_n c JOIN rec r ON r.id = c.doc_id)""")
def sort_len(spark, sf):
    c = rec_corpus(spark, sf, targets=(COLL,))
    c = c.with_(docs=T.tokenise(c.docs))
    return O.sort_len(c, COLL).select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), "n",
                                      "ord")


REVIEW = """
pos AS (SELECT doc_id, row_number() OVER (ORDER BY k) - 1 AS ord FROM bdocs),
visited AS (SELECT doc_id FROM bdocs WHERE k % 7 = 0),
accepted AS (SELECT doc_id FROM bdocs WHERE k % 21 = 0),
acc AS (SELECT c.idx, c.uri, c.label, count(a.doc_id) AS accepted
        FROM bcats c LEFT JOIN ab a ON a.uri = c.uri AND a.doc_id IN (SELECT doc_id FROM accepted)
        GROUP BY c.idx, c.uri, c.label),
rel AS (SELECT a.doc_id, a.uri, p.ord FROM ab a JOIN pos p ON p.doc_id = a.doc_id
        WHERE a.doc_id NOT IN (SELECT doc_id FROM visited)),
goal AS (SELECT max(accepted) + 20 AS hits FROM acc)"""
WB = with_(BRAND, REVIEW)


def _review_inputs(spark, sf):
    """The corpus, its positions, the id lists, and a goal that no category has reached: 20 above the largest."""
    visited, accepted = FX.review_lists(spark, sf)
    corpus = brand_corpus(spark, sf)
    most = O.coverage_report(corpus, "brand", accepted).agg(F.max("accepted")).first()[0]
    return corpus, brand_positions(spark, sf), visited, accepted, int(most or 0) + 20


@query("next_candidate", WB + """
SELECT r.doc_id, r.uri, c.idx, c.accepted, r.ord FROM rel r JOIN acc c ON c.uri = r.uri
WHERE c.accepted <= (SELECT hits FROM goal) ORDER BY c.accepted, c.idx, r.ord LIMIT 1""")
def next_candidate(spark, sf):
    c, pos, visited, accepted, goal = _review_inputs(spark, sf)
    return O.next_candidate(c, "brand", pos, visited, accepted, goal)


@query("review_queue", WB + """
SELECT doc_id, uri, idx, label, accepted, ord, rank FROM (
  SELECT r.doc_id, r.uri, c.idx, c.label, c.accepted, r.ord,
         row_number() OVER (PARTITION BY c.idx ORDER BY r.ord) AS rank
  FROM rel r JOIN acc c ON c.uri = r.uri WHERE c.accepted < (SELECT hits FROM goal))
WHERE rank <= (SELECT hits FROM goal) - accepted""")
def review_queue(spark, sf):
    c, pos, visited, accepted, goal = _review_inputs(spark, sf)
    return O.review_queue(c, "brand", pos, visited, accepted, goal) \
        .select("doc_id", "uri", "idx", "label", "accepted", "ord", F.col("rank").cast("long").alias("rank"))


@query("coverage_report", WB + """
SELECT c.idx, c.uri, c.label, count(a.doc_id) AS candidates, acc.accepted
FROM bcats c LEFT JOIN ab a ON a.uri = c.uri JOIN acc ON acc.idx = c.idx
GROUP BY c.idx, c.uri, c.label, acc.accepted""")
def coverage_report(spark, sf):
    _, accepted = FX.review_lists(spark, sf)
    return O.coverage_report(brand_corpus(spark, sf), "brand", accepted)


# --- I -----------------------------------------------------------------------------

SPLIT = """
keys AS MATERIALIZED (SELECT doc_id, md5('0:' || doc_id) AS key FROM bdocs),
targets AS (SELECT c.uri, count(a.doc_id) AS count,
                   CAST(round_even(CAST(count(a.doc_id) AS DOUBLE) * 0.3, 0) AS BIGINT) AS target
            FROM bcats c LEFT JOIN ab a ON a.uri = c.uri GROUP BY c.uri),
cand AS MATERIALIZED (SELECT DISTINCT doc_id FROM (
           SELECT a.doc_id, t.target, row_number() OVER (PARTITION BY a.uri ORDER BY k.key) AS rn
           FROM ab a JOIN keys k ON k.doc_id = a.doc_id JOIN targets t ON t.uri = a.uri)
         WHERE rn <= target)"""
# sequential greedy walk: the brute-force reference for the parallel rounds
GREEDY = """
cats AS MATERIALIZED (SELECT uri, CAST(row_number() OVER (ORDER BY uri) AS INTEGER) AS ci FROM bcats),
tl AS MATERIALIZED (SELECT list(t.target ORDER BY c.ci) AS tg FROM targets t JOIN cats c ON c.uri = t.uri),
walk_docs AS MATERIALIZED (
  SELECT cd.doc_id, row_number() OVER (ORDER BY k.key) AS step,
         (SELECT list(c.ci) FROM ab a JOIN cats c ON c.uri = a.uri WHERE a.doc_id = cd.doc_id) AS cis,
         (SELECT tg FROM tl) AS tg
  FROM cand cd JOIN keys k ON k.doc_id = cd.doc_id),
init AS MATERIALIZED (SELECT list(coalesce(n, 0) ORDER BY c.ci) AS cnt
         FROM cats c LEFT JOIN (SELECT a.uri, count(*) AS n FROM ab a JOIN cand USING (doc_id) GROUP BY a.uri) x
           ON x.uri = c.uri),
walk AS (
  SELECT * FROM (
  WITH RECURSIVE w(step, cnt, removed_doc) AS (
    SELECT 0, (SELECT cnt FROM init), CAST(NULL AS VARCHAR)
    UNION ALL
    SELECT w.step + 1,
           CASE WHEN list_bool_and(list_transform(d.cis, lambda c: w.cnt[c] - 1 >= d.tg[c]))
                THEN list_transform(generate_series(1, len(w.cnt)),
                                    lambda j: w.cnt[j] - CASE WHEN list_contains(d.cis, j) THEN 1 ELSE 0 END)
                ELSE w.cnt END,
           CASE WHEN list_bool_and(list_transform(d.cis, lambda c: w.cnt[c] - 1 >= d.tg[c]))
                THEN d.doc_id END
    FROM w JOIN walk_docs d ON d.step = w.step + 1)
  SELECT * FROM w)),
kept AS (SELECT doc_id FROM cand WHERE doc_id NOT IN (SELECT removed_doc FROM walk WHERE removed_doc IS NOT NULL))"""
WS = with_(BRAND, SPLIT)


@query("split_order", WS + "SELECT doc_id, key FROM keys")
def split_order(spark, sf):
    d = brand_corpus(spark, sf).docs
    return d.select("doc_id", S.split_key(F.col("doc_id"), 0).alias("key"))


@query("split_targets", WS + "SELECT uri, count, target FROM targets")
def split_targets(spark, sf):
    return S.split_targets(brand_corpus(spark, sf), "brand", 0.3)


@query("split_candidates", WS + "SELECT doc_id FROM cand")
def split_candidates(spark, sf):
    return S.split_candidates(brand_corpus(spark, sf), "brand", 0.3, 0)


WG = with_(BRAND, SPLIT, GREEDY)


@query("split_pruned", WG + "SELECT doc_id FROM kept")
def split_pruned(spark, sf):
    return S.split_pruned(brand_corpus(spark, sf), "brand", 0.3, 0)


@query("split_kept", WG + "SELECT doc_id FROM kept")
def split_kept(spark, sf):
    _, kept = S.balanced_split(brand_corpus(spark, sf), "brand", 0.3, 0)
    return kept.docs.select("doc_id")


@query("split_rest", WG + "SELECT doc_id FROM bdocs WHERE doc_id NOT IN (SELECT doc_id FROM kept)")
def split_rest(spark, sf):
    rest, _ = S.balanced_split(brand_corpus(spark, sf), "brand", 0.3, 0)
    return rest.docs.select("doc_id")


# --- J -----------------------------------------------------------------------------

PREDS = """
pbase AS (SELECT l.doc_id, l.quality, l.toxic, d.n_chars, d.source FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id),
truth AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'quality' AS label FROM pbase WHERE quality = 1
          UNION ALL SELECT CAST(doc_id AS VARCHAR), 'toxic' FROM pbase WHERE toxic = 1),
pred AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'quality' AS label FROM pbase WHERE n_chars > 2000
         UNION ALL SELECT CAST(doc_id AS VARCHAR), 'toxic' FROM pbase WHERE source IN ('src1', 'src3', 'src5')),
outc AS (SELECT coalesce(t.doc_id, p.doc_id) AS doc_id, coalesce(t.label, p.label) AS label,
                CASE WHEN t.doc_id IS NOT NULL AND p.doc_id IS NOT NULL THEN 1 ELSE 0 END AS tp,
                CASE WHEN t.doc_id IS NULL THEN 1 ELSE 0 END AS fp,
                CASE WHEN p.doc_id IS NULL THEN 1 ELSE 0 END AS fn
         FROM truth t FULL OUTER JOIN pred p ON t.doc_id = p.doc_id AND t.label = p.label),
pc AS (SELECT label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM outc GROUP BY label),
pcm AS (SELECT label,
          CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
          CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, CAST(tp + fn AS BIGINT) AS support
        FROM (SELECT label, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn FROM pc)),
pcf AS (SELECT label, p, r, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f1, support FROM pcm)"""
WP = with_(PREDS)


def _preds(spark, sf):
    return FX.preds(spark, sf)


@query("eval_per_class", WP + """
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM pcf""")
def eval_per_class(spark, sf):
    _, truth, pred = _preds(spark, sf)
    return R.per_class(truth, pred)


@query("eval_micro", WP + """
SELECT 'micro avg' AS avg, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END, 6) AS f1, support
FROM (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, CAST(tp + fn AS BIGINT) AS support
      FROM (SELECT CAST(sum(tp) AS DOUBLE) AS tp, CAST(sum(fp) AS DOUBLE) AS fp, CAST(sum(fn) AS DOUBLE) AS fn
            FROM outc))""")
def eval_micro(spark, sf):
    _, truth, pred = _preds(spark, sf)
    return R.micro_avg(truth, pred)


@query("eval_macro", WP + """
SELECT 'macro avg' AS avg, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall,
       round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM pcf""")
def eval_macro(spark, sf):
    _, truth, pred = _preds(spark, sf)
    return R.macro_weighted_avg(truth, pred).where(F.col("avg") == "macro avg")


@query("eval_weighted", WP + """
SELECT 'weighted avg' AS avg,
       round(sum(p * support) / sum(support), 6) AS precision,
       round(sum(r * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1, CAST(sum(support) AS BIGINT) AS support
FROM pcf""")
def eval_weighted(spark, sf):
    _, truth, pred = _preds(spark, sf)
    return R.macro_weighted_avg(truth, pred).where(F.col("avg") == "weighted avg")


@query("eval_samples", WP + """
SELECT 'samples avg' AS avg, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f1), 6) AS f1,
       CAST(sum(support) AS BIGINT) AS support
FROM (SELECT p, r, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f1, support
      FROM (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                   CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, tp + fn AS support
            FROM (SELECT CAST(b.doc_id AS VARCHAR) AS doc_id, CAST(coalesce(sum(o.tp), 0) AS DOUBLE) AS tp,
                         CAST(coalesce(sum(o.fp), 0) AS DOUBLE) AS fp, CAST(coalesce(sum(o.fn), 0) AS DOUBLE) AS fn
                  FROM pbase b LEFT JOIN outc o ON o.doc_id = CAST(b.doc_id AS VARCHAR) GROUP BY b.doc_id)))""")
def eval_samples(spark, sf):
    docs, truth, pred = _preds(spark, sf)
    return R.samples_avg(truth, pred, docs)


MULTI = """
sl AS (SELECT CAST(l.doc_id AS VARCHAR) AS doc_id,
              CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good' ELSE 'poor' END AS t,
              CASE WHEN d.source IN ('src1', 'src3', 'src5') THEN 'toxic' WHEN d.n_chars > 2000 THEN 'good'
                   ELSE 'poor' END AS p
       FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id),
cls AS (SELECT t AS label FROM sl UNION SELECT p FROM sl),
cnt AS (SELECT c.label,
               CAST(sum(CASE WHEN s.t = c.label AND s.p = c.label THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
               CAST(sum(CASE WHEN s.t <> c.label AND s.p = c.label THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
               CAST(sum(CASE WHEN s.t = c.label AND s.p <> c.label THEN 1 ELSE 0 END) AS DOUBLE) AS fn
        FROM cls c, sl s GROUP BY c.label)"""


@query("eval_multiclass", with_(MULTI) + """
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END, 6) AS f1, support,
       (SELECT round(avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END), 6) FROM sl) AS accuracy
FROM (SELECT label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, CAST(tp + fn AS BIGINT) AS support
      FROM cnt)""")
def eval_multiclass(spark, sf):
    truth, pred = FX.single_label_preds(spark, sf)
    return R.multiclass_report(truth, pred)


@query("eval_named", WP + """
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support,
       upper(label) AS name FROM pcf""")
def eval_named(spark, sf):
    _, truth, pred = _preds(spark, sf)
    names = truth.select("label").distinct().select("label", F.upper("label").alias("name"))
    return R.named(R.per_class(truth, pred), names)


@query("eval_multiclass_averages", with_(MULTI) + """
SELECT kind AS avg, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support
FROM (SELECT avg(p) AS p, avg(r) AS r, avg(f1) AS f1, CAST(sum(support) AS BIGINT) AS support, 'macro avg' AS kind FROM mf
      UNION ALL SELECT sum(p * support) / sum(support), sum(r * support) / sum(support),
                       sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT), 'weighted avg' FROM mf)""".replace(
    "FROM mf", """FROM (SELECT p, r, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f1, support
      FROM (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                   CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, tp + fn AS support FROM cnt))"""))
def eval_multiclass_averages(spark, sf):
    truth, pred = FX.single_label_preds(spark, sf)
    return R.multiclass_averages(truth, pred)


REPORT_CLASSES = ("quality", "toxic", "spam")  # the last one occurs nowhere


@query("classification_report", WP + """,
allpc AS (SELECT c.label, coalesce(p, 0.0) AS p, coalesce(r, 0.0) AS r, coalesce(f1, 0.0) AS f1, coalesce(support, 0) AS support
          FROM (VALUES ('quality'), ('toxic'), ('spam')) c(label) LEFT JOIN pcf ON pcf.label = c.label),
tot AS (SELECT CAST(sum(tp) AS DOUBLE) AS tp, CAST(sum(fp) AS DOUBLE) AS fp, CAST(sum(fn) AS DOUBLE) AS fn FROM outc),
perdoc AS (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r, tp + fn AS support
           FROM (SELECT b.doc_id, CAST(coalesce(sum(o.tp), 0) AS DOUBLE) AS tp, CAST(coalesce(sum(o.fp), 0) AS DOUBLE) AS fp,
                        CAST(coalesce(sum(o.fn), 0) AS DOUBLE) AS fn
                 FROM pbase b LEFT JOIN outc o ON o.doc_id = CAST(b.doc_id AS VARCHAR) GROUP BY b.doc_id)),
lines AS (
  SELECT label AS avg, p, r, f1, support FROM allpc
  UNION ALL SELECT 'micro avg', tp / (tp + fp), tp / (tp + fn), 2.0 * tp / (2.0 * tp + fp + fn), CAST(tp + fn AS BIGINT) FROM tot
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), CAST(sum(support) AS BIGINT) FROM allpc
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM allpc
  UNION ALL SELECT 'samples avg', avg(p), avg(r), avg(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END),
                   CAST(sum(support) AS BIGINT) FROM perdoc)
SELECT avg, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support,
       CASE WHEN avg IN ('quality', 'toxic', 'spam') THEN upper(avg) END AS name FROM lines""")
def classification_report(spark, sf):
    docs, truth, pred = _preds(spark, sf)
    classes = spark.createDataFrame([(c,) for c in REPORT_CLASSES], "label string")
    return R.classification_report(truth, pred, docs, classes, classes.select("label", F.upper("label").alias("name")))
