"""Driver queries for tokens and bags of words (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.fields import EXCLUDED_POS_TAGS
from corpuskit.operators import corpus as C
from corpuskit.operators import text as T
from corpuskit.operators.prune import prune_fixpoint
from corpuskit.plans.oracle_views import TEXT_ASSIGN, TOK, with_
from corpuskit.plans.registry import query
from corpuskit.sources import fixtures as FX

def empty():
    return F.array().cast("array<string>")


def text_corpus(spark, sf, tokens: bool = True) -> C.Corpus:
    """Every document; category field ``topic`` = source, plus language when doc_id % 4 = 3."""
    docs = FX.spread(FX.table(spark, sf, "documents"))
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("raw_text"),
                    F.lit(False).alias("editor"), empty().alias("test_fields"),
                    F.concat(F.array("source"), F.when(F.col("doc_id") % 4 == 3, F.array("lang"))
                             .otherwise(empty())).alias("vals"))
    a, c = C.encode(d.select("doc_id", "vals"), "topic")
    d = d.drop("vals")
    if tokens:
        d = T.tokenise(d)
    return C.Corpus(docs=d, assignments=a, categories=c, fields=("topic",))


def token_summary(docs):
    return docs.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                       F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


def summary_sql(kept_cte: str, *ctes: str) -> str:
    """Oracle: ``kept(doc_id, pos, word)`` -> per document count and md5 of the joined tokens."""
    return with_(*ctes, kept_cte) + """
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, count(k.word) AS n_tokens,
       md5(coalesce(string_agg(k.word, ' ' ORDER BY k.pos), '')) AS tokens_md5
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id GROUP BY d.doc_id"""


WT = with_(TOK)


@query("tokenise", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(len(ws) AS BIGINT) AS n_tokens,
       md5(array_to_string(ws, ' ')) AS tokens_md5
FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM documents)""")
def tokenise_q(spark, sf):
    return token_summary(text_corpus(spark, sf).docs)


_SW_VALUES = ", ".join(f"('{w}', '{lang}')" for lang, ws in T.STOPWORDS.items() for w in ws)
VOTE = f"""
sw(word, lang) AS (VALUES {_SW_VALUES}),
votes AS (SELECT t.doc_id, s.lang, count(*) AS n FROM tok t JOIN sw s ON lower(t.word) = s.word GROUP BY 1, 2),
best AS (SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang ASC) AS rn
                                   FROM votes) WHERE rn = 1)"""


@query("language_vote", with_(TOK, VOTE) + """
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, b.lang AS language FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id""")
def language_vote(spark, sf):
    return T.language_vote(text_corpus(spark, sf).docs).select("doc_id", "language")


@query("keep_language", with_(TOK, VOTE) + """
SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM best WHERE lang = 'de'""")
def keep_language(spark, sf):
    c = text_corpus(spark, sf)
    c = T.keep_language(c.with_(docs=T.language_vote(c.docs)), "de")
    return c.docs.select("doc_id")


REPETITION_KEPT = """
kept AS (
  SELECT doc_id, pos, word FROM (
    SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS len,
           pos - min(pos) OVER (PARTITION BY doc_id, run) AS rk
    FROM (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run
          FROM (SELECT doc_id, pos, word,
                       CASE WHEN lag(word) OVER (PARTITION BY doc_id ORDER BY pos) IS NULL
                              OR lag(word) OVER (PARTITION BY doc_id ORDER BY pos) <> word THEN 1 ELSE 0 END AS nw
                FROM tok)))
  WHERE len < 2 OR rk < 1)"""


@query("repetition", summary_sql(REPETITION_KEPT, TOK))
def repetition(spark, sf):
    return token_summary(T.repetition_filter(text_corpus(spark, sf).docs, 2, 1))


@query("drop_tags", summary_sql(r"""
kept AS (SELECT * FROM tok WHERE NOT (regexp_full_match(word, '[\p{N}]+') OR length(word) = 1))""", TOK))
def drop_tags(spark, sf):
    return token_summary(T.drop_tags(text_corpus(spark, sf).docs, ["NUM", "CHAR"]))


_CLOSED = ", ".join(sorted({f"'{w}'" for tag, ws in T.CLOSED_CLASSES.items() if tag in EXCLUDED_POS_TAGS for w in ws}))
#: Whether the training job's default tagger gives a word a tag that is excluded.
EXCLUDED_WORD = f"(lower(word) IN ({_CLOSED}) OR (length(word) = 1 AND NOT regexp_matches(word, '\\p{{N}}')))"


@query("drop_pos_tags", summary_sql(f"kept AS (SELECT * FROM tok WHERE NOT {EXCLUDED_WORD})", TOK))
def drop_pos_tags(spark, sf):
    """G6 with a tagger in Python: an Arrow stage tags each document, the excluded classes go."""
    return token_summary(T.drop_tags(T.tag_tokens(text_corpus(spark, sf).docs), EXCLUDED_POS_TAGS, tagged_col="tagged"))


@query("df_interval", summary_sql("""
kept AS (
  SELECT * FROM tok WHERE word IN (
    SELECT word FROM (SELECT word, count(DISTINCT doc_id) AS df FROM tok GROUP BY word)
    WHERE df >= 10 AND df <= 0.25 * (SELECT count(*) FROM documents)))""", TOK))
def df_interval(spark, sf):
    return token_summary(T.df_interval(text_corpus(spark, sf).docs, 10, 0.25))


@query("drop_short_sentences", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, flatten(list_filter(list_transform(string_split_regex(text, '[.!?\n]+'),
                                                         lambda s: regexp_extract_all(s, '[\p{L}\p{N}]+')),
                                          lambda x: len(x) >= 6)) AS t
      FROM documents)""")
def drop_short_sentences(spark, sf):
    c = text_corpus(spark, sf, tokens=False)
    return token_summary(T.drop_short_sentences(c.docs, 6))


@query("drop_short_docs", WT + """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, count(*) AS n_tokens FROM tok GROUP BY doc_id HAVING count(*) >= 20""")
def drop_short_docs(spark, sf):
    c = T.drop_short_docs(text_corpus(spark, sf), 20)
    return c.docs.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))


BOW = """
bow AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, word, CAST(count(*) AS INTEGER) AS n
        FROM tok GROUP BY doc_id, word)"""


@query("bow", with_(TOK, BOW) + "SELECT doc_id, word, n FROM bow")
def bow(spark, sf):
    return T.bag_of_words(text_corpus(spark, sf)).bow


BENCH_VOCAB = r"""
bvocab AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS word FROM benchmark)"""


def benchmark_words(spark, sf):
    b = FX.table(spark, sf, "benchmark")
    return b.select(F.explode(F.regexp_extract_all("text", F.lit(T.TOKEN_PATTERN), 0)).alias("word")) \
        .distinct()


@query("bow_vocab", with_(TOK, BOW, BENCH_VOCAB) + """
SELECT v.word, count(b.doc_id) AS support, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS total
FROM bvocab v LEFT JOIN bow b ON b.word = v.word GROUP BY v.word""")
def bow_vocab(spark, sf):
    c = T.bag_of_words(text_corpus(spark, sf), benchmark_words(spark, sf))
    return T.bow_stats(c)[1]


@query("sync_tokens", summary_sql("kept AS (SELECT * FROM tok WHERE word IN (SELECT word FROM bvocab))",
                                  TOK, BENCH_VOCAB))
def sync_tokens(spark, sf):
    c = T.bag_of_words(text_corpus(spark, sf), benchmark_words(spark, sf))
    return token_summary(c.docs)


@query("bow_from_raw", with_(TOK, BOW) + """
SELECT doc_id, count(*) AS n_words, CAST(sum(n) AS BIGINT) AS total FROM bow GROUP BY doc_id""")
def bow_from_raw(spark, sf):
    c = T.bow_from_raw(text_corpus(spark, sf, tokens=False))
    return c.bow.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"),
                                       F.sum("n").cast("long").alias("total"))


@query("drop_long_tokens", summary_sql("kept AS (SELECT * FROM tok WHERE length(word) <= 30)", TOK))
def drop_long_tokens(spark, sf):
    c = T.drop_long_tokens(T.bag_of_words(text_corpus(spark, sf)), 30)
    return token_summary(c.docs)


@query("bow_stats", with_(TOK, BOW) + """
SELECT word, count(*) AS support, CAST(sum(n) AS BIGINT) AS total FROM bow GROUP BY word""")
def bow_stats(spark, sf):
    return T.bow_stats(T.bag_of_words(text_corpus(spark, sf)))[1]


def prune_ctes(min_doc: int = 10, min_word: int = 5, min_cat: int = 10, rounds: int = 16) -> list[str]:
    """Fixpoint rounds and the entry condition over ``alldocs(doc_id)``, ``b0(doc_id, word, n)``, ``a0(field, doc_id, uri)``
    and ``k0(field, uri)``, giving ``final_docs``, ``final_b`` and ``final_a``.

    SQL cannot loop over aggregates, so the rounds are written out; where the last one still removed a row,
    the query fails instead of giving a wrong result.
    """
    ctes = []
    for i in range(1, rounds + 1):
        p = i - 1
        ctes.append(f"""
w{i} AS (SELECT word FROM b{p} GROUP BY word HAVING count(*) >= {min_word}),
bw{i} AS (SELECT * FROM b{p} WHERE word IN (SELECT word FROM w{i})),
d{i} AS (SELECT doc_id FROM bw{i} GROUP BY doc_id HAVING sum(n) >= {min_doc}),
ax{i} AS (SELECT * FROM a{p} WHERE doc_id IN (SELECT doc_id FROM d{i})),
c{i} AS (SELECT field, uri FROM ax{i} GROUP BY field, uri HAVING count(*) >= {min_cat}),
ay{i} AS (SELECT a.* FROM ax{i} a JOIN c{i} c ON a.field = c.field AND a.uri IS NOT DISTINCT FROM c.uri),
dd{i} AS (SELECT doc_id FROM d{i} WHERE doc_id IN (SELECT doc_id FROM ay{i})),
b{i} AS MATERIALIZED (SELECT * FROM bw{i} WHERE doc_id IN (SELECT doc_id FROM dd{i})),
a{i} AS MATERIALIZED (SELECT * FROM ay{i} WHERE doc_id IN (SELECT doc_id FROM dd{i}))""")
    r = rounds
    ctes.append(f"""
viol AS (SELECT
  (SELECT min(coalesce(l, 0)) FROM alldocs x LEFT JOIN (SELECT doc_id, sum(n) AS l FROM b0 GROUP BY doc_id) y
     ON x.doc_id = y.doc_id) < {min_doc}
  OR (SELECT min(s) FROM (SELECT count(*) AS s FROM b0 GROUP BY word)) < {min_word}
  OR (SELECT min(s) FROM (SELECT count(a.doc_id) AS s FROM k0 k LEFT JOIN a0 a
        ON a.field = k.field AND a.uri IS NOT DISTINCT FROM k.uri GROUP BY k.field, k.uri)) < {min_cat} AS v),
done AS (SELECT CASE WHEN (SELECT count(*) FROM b{r - 1}) <> (SELECT count(*) FROM b{r})
                     THEN error('the fixpoint needs more than {r} rounds') ELSE true END AS ok),
final_docs AS (
  SELECT doc_id FROM alldocs WHERE NOT (SELECT v FROM viol)
  UNION ALL SELECT doc_id FROM dd{r} WHERE (SELECT v AND ok FROM viol, done)),
final_b AS (SELECT * FROM b0 WHERE NOT (SELECT v FROM viol) UNION ALL SELECT * FROM b{r} WHERE (SELECT v FROM viol)),
final_a AS (SELECT * FROM a0 WHERE NOT (SELECT v FROM viol) UNION ALL SELECT * FROM a{r} WHERE (SELECT v FROM viol))""")
    return ctes


def prune_sql() -> str:
    """The fixpoint over the text corpus."""
    return with_(TOK, BOW, TEXT_ASSIGN, "b0 AS (SELECT doc_id, word, n FROM bow)", "a0 AS (SELECT field, doc_id, uri FROM tassign)",
                 "k0 AS (SELECT DISTINCT field, uri FROM a0)", "alldocs AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents)",
                 *prune_ctes()) + """
SELECT f.doc_id, CAST(coalesce(l, 0) AS BIGINT) AS length, coalesce(c, 0) AS n_cats
FROM final_docs f LEFT JOIN (SELECT doc_id, sum(n) AS l FROM final_b GROUP BY doc_id) x ON x.doc_id = f.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS c FROM final_a GROUP BY doc_id) y ON y.doc_id = f.doc_id"""


@query("prune_fixpoint", prune_sql())
def prune_fixpoint_q(spark, sf):
    c = prune_fixpoint(T.bag_of_words(text_corpus(spark, sf)), 10, 5, 10)
    lens = c.bow.groupBy("doc_id").agg(F.sum("n").cast("long").alias("length"))
    cats = c.assignments.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_cats"))
    return (c.docs.select("doc_id").join(lens, "doc_id", "left").join(cats, "doc_id", "left")
            .select("doc_id", F.coalesce("length", F.lit(0)).cast("long").alias("length"),
                    F.coalesce("n_cats", F.lit(0)).cast("long").alias("n_cats")))


@query("vocab_index", WT + """
SELECT word, CAST(row_number() OVER (ORDER BY word) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT word FROM tok WHERE length(word) <= 4)""")
def vocab_index(spark, sf):
    """the matrix columns of the words that a subset of the vocabulary keeps."""
    c = T.bag_of_words(text_corpus(spark, sf))
    return C.vocabulary(C.subset_vocab(c, c.vocab.where(F.length("word") <= 4).select("word")))


@query("subset_vocab", summary_sql("kept AS (SELECT * FROM tok WHERE length(word) <= 4)", TOK))
def subset_vocab(spark, sf):
    """keep the short words of the vocabulary; tokens lose the others (order kept)."""
    c = T.bag_of_words(text_corpus(spark, sf))
    return token_summary(C.subset_vocab(c, c.vocab.where(F.length("word") <= 4).select("word")).docs)
