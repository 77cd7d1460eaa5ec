"""The long, keyed corpus model and its encode / subset operators.

``Corpus`` replaces parallel dense arrays by keyed tables:

* ``docs(doc_id, raw_text, editor, test_fields[, language, tokens])``
* ``assignments(field, doc_id, uri)`` -- one row per (document, category)
* ``categories(field, idx, uri, label)`` -- matrix columns; may have zero support
* ``bow(doc_id, word, n)`` once a bag of words exists, and ``words(word)`` where the vocabulary
  is given apart from it; ``vocabulary`` ranks the words when somebody reads their matrix columns

Category URIs may be NULL (a NULL inside a value list is a category), so joins on
``uri`` are null-safe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.operators.hot import hot_words, judge_tokens, keep_words
from corpuskit.operators.ordinal import with_group_ordinal, with_ordinal
from corpuskit.session import materialize


@dataclass(frozen=True)
class Corpus:
    docs: DataFrame
    assignments: DataFrame
    categories: DataFrame
    fields: tuple[str, ...]
    bow: DataFrame | None = None
    words: DataFrame | None = None

    @property
    def vocab(self) -> DataFrame | None:
        """``(word)``: the given vocabulary, or the words of the bag of words."""
        return self.bow.select("word").distinct() if self.words is None and self.bow is not None else self.words

    def with_(self, **kw) -> "Corpus":
        return replace(self, **kw)

    def check_field(self, field: str) -> None:
        if field not in self.fields and field != "bows":
            raise ValueError(f"no field {field!r} in this corpus; it has {', '.join(self.fields)}")


def _uri_eq(left: DataFrame, right: DataFrame) -> Column:
    return (left["field"] == right["field"]) & left["uri"].eqNullSafe(right["uri"])


def category_index(distinct_uris: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """``(field, uri)`` -> ``(field, idx, uri)``; default order: uri ascending, NULL first.

    All fields are ranked in one global sort over many tasks, however many categories a
    field has.
    """
    order = order or [F.col("uri").asc_nulls_first()]
    ranked = with_group_ordinal(distinct_uris.select("field", "uri"), "field", order, "idx")
    return ranked.select("field", F.col("idx").cast("int").alias("idx"), "uri")


def assigned(values: DataFrame, field: str) -> DataFrame:
    """``values(doc_id, vals ARRAY<STRING>)`` -> ``(field, doc_id, uri)``; duplicates inside a
    document collapse in its row (``array_distinct``)."""
    return values.select(F.lit(field).alias("field"), "doc_id", F.explode(F.array_distinct("vals")).alias("uri"))


def rank_categories(assignments: DataFrame, fields: Sequence[str], orders: Mapping[str, list[Column]] = {}) -> DataFrame:  # noqa: B006
    """``(field, idx, uri)`` of the categories assigned; fields without an order of their own are ranked together.

    The only shuffle of the assignments is the distinct over category URIs (partially aggregated).
    """
    # the same partial aggregate as ``support``: a plan needing both reuses one exchange
    uris = assignments.groupBy("field", "uri").agg(F.count(F.lit(1)).alias("support")).select("field", "uri")
    plain = [f for f in fields if not orders.get(f)]
    parts = [category_index(uris.where(F.col("field") == f), orders[f]) for f in fields if orders.get(f)]
    if plain:
        parts.append(category_index(uris if len(plain) == len(fields) else uris.where(F.col("field").isin(*plain))))
    return reduce(DataFrame.unionByName, parts)


def encode(values: DataFrame, field: str, order: list[Column] | None = None,
           labels: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``values(doc_id, vals ARRAY<STRING>)`` -> ``(assignments, categories)``."""
    assignments = assigned(values, field)
    return assignments, attach_labels(rank_categories(assignments, [field], {field: order}), labels)


def label_categories(categories: DataFrame, labels: Mapping[str, DataFrame] | DataFrame | None,
                     uri_labels: DataFrame | None = None) -> DataFrame:
    """``(field, idx, uri, label)``: labels of a vocabulary per field, else of a table by URI."""
    if isinstance(labels, Mapping):
        tables = [t.select(F.lit(f).alias("field"), "uri", "label") for f, t in labels.items() if t is not None]
        labels = reduce(DataFrame.unionByName, tables) if tables else None
    if labels is None:
        out = categories.withColumn("label", F.lit(None).cast("string"))
    else:
        own = labels.select(F.col("field").alias("__lf"), F.col("uri").alias("__lu"), "label")
        out = categories.join(own, (F.col("field") == F.col("__lf")) & (F.col("uri") == F.col("__lu")), "left") \
            .select("field", "idx", "uri", "label")
    if uri_labels is None:
        return out
    from corpuskit.operators.vocab import labels_by_uri

    by_uri = labels_by_uri(out, "uri", uri_labels, "__by_uri")
    if labels is None:
        return by_uri.select("field", "idx", "uri", F.col("__by_uri").alias("label"))
    known = labels.select(F.col("field").alias("__kf")).distinct()  # a field with a vocabulary takes no label by URI
    return by_uri.join(known, F.col("field") == F.col("__kf"), "left").select("field", "idx", "uri", F.when(
        F.col("__kf").isNull(), F.col("__by_uri")).otherwise(F.col("label")).alias("label"))


def attach_labels(categories: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Left join a ``(uri, label)`` table (one row per uri) onto categories."""
    if labels is None:
        return categories.withColumn("label", F.lit(None).cast("string"))
    lab = labels.select(F.col("uri").alias("__luri"), F.col("label"))
    return (categories.join(lab, categories["uri"] == lab["__luri"], "left")
            .select("field", "idx", "uri", "label"))


def support(corpus: Corpus, field: str | None = None) -> DataFrame:
    """``(field, idx, uri, label, support)``, zero-support categories included."""
    a = corpus.assignments if field is None else corpus.assignments.where(F.col("field") == field)
    c = corpus.categories if field is None else corpus.categories.where(F.col("field") == field)
    counts = a.groupBy("field", "uri").agg(F.count(F.lit(1)).alias("support"))
    j = c.join(counts, _uri_eq(c, counts), "left")
    return j.select(c["field"], c["idx"], c["uri"], c["label"],
                    F.coalesce(counts["support"], F.lit(0)).cast("long").alias("support"))


def labels_per_doc(corpus: Corpus, field: str | None = None) -> DataFrame:
    """``(doc_id, n)`` for every document (0 when unassigned)."""
    a = corpus.assignments if field is None else corpus.assignments.where(F.col("field") == field)
    counts = a.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return (corpus.docs.select("doc_id").join(counts, "doc_id", "left")
            .select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def subset_docs(corpus: Corpus, keep: DataFrame) -> Corpus:
    """keep documents whose ``doc_id`` is in ``keep``; categories and vocab stay."""
    ids = keep.select("doc_id").distinct()
    docs = corpus.docs.join(ids, "doc_id", "left_semi")
    out = corpus.with_(docs=docs, assignments=corpus.assignments.join(ids, "doc_id", "left_semi"))
    if corpus.bow is not None:
        out = out.with_(bow=corpus.bow.join(ids, "doc_id", "left_semi"))
    return out


def subset_categories(corpus: Corpus, field: str, keep: DataFrame) -> Corpus:
    """keep categories of ``field`` listed in ``keep(uri)``; re-rank ``idx``.

    Other fields are untouched; documents stay. ``field="bows"`` subsets the
    vocabulary (F7) and also removes the words from the token sequences.
    """
    corpus.check_field(field)
    if field == "bows":
        return subset_vocab(corpus, keep.select(F.col("uri").alias("word")))
    keep_u = keep.select(F.lit(field).alias("field"), "uri").distinct()
    cats = corpus.categories
    this = cats.where(F.col("field") == field)
    kept = this.join(keep_u, _uri_eq(this, keep_u), "left_semi")
    kept = with_group_ordinal(kept.withColumnRenamed("idx", "__old"), "field", ["__old"], "idx") \
        .select("field", F.col("idx").cast("int").alias("idx"), "uri", "label")
    others = cats.where(F.col("field") != field)
    a = corpus.assignments
    a_this = a.where(F.col("field") == field)
    a_kept = a_this.join(keep_u, _uri_eq(a_this, keep_u), "left_semi")
    return corpus.with_(categories=others.unionByName(kept),
                        assignments=a.where(F.col("field") != field).unionByName(a_kept))


def token_words(docs: DataFrame, col: str = "tokens") -> DataFrame:
    """``(word, df)``: documents containing the word (distinct per row first, so the
    count is a plain partial aggregate)."""
    return (docs.select("doc_id", F.explode(F.array_distinct(col)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("df")))


def filter_tokens(docs: DataFrame, keep_words: DataFrame, col: str = "tokens", hot: list[str] | None = None) -> DataFrame:
    """Remove tokens not in ``keep_words(word)``, keeping order and repeats.

    The words of most documents (``hot``, found by a count where it is not given) are judged inside
    their rows; only tokens of the other words are shuffled, with their positions.
    """
    hot = hot_words(token_words(docs, col), "df") if hot is None else hot
    return judge_tokens(docs, keep_words, hot, col)


def drop_tokens(docs: DataFrame, words: DataFrame, col: str = "tokens", hot: list[str] | None = None) -> DataFrame:
    """Remove tokens that are in ``words(word)``; the counterpart of :func:`filter_tokens`."""
    hot = hot_words(token_words(docs, col), "df") if hot is None else hot
    return judge_tokens(docs, words, hot, col, keep=False)


def vocabulary(corpus: Corpus) -> DataFrame:
    """``(word, idx)``: the corpus's words with their matrix columns, by word."""
    ranked = with_ordinal(corpus.vocab.select("word"), ["word"], "idx")
    return ranked.select("word", F.col("idx").cast("int").alias("idx"))


def subset_vocab(corpus: Corpus, keep_words_: DataFrame) -> Corpus:
    """Restrict the vocabulary; tokens lose the removed words."""
    # written once: read by the tokens, the bag of words and the vocabulary
    words = materialize(keep_words_.select("word").distinct(), "vocabulary")
    out = corpus
    if corpus.words is not None:
        out = out.with_(words=corpus.words.join(words, "word", "left_semi"))
    hot = None
    if "tokens" in corpus.docs.columns:
        hot = hot_words(token_words(corpus.docs), "df")
        out = out.with_(docs=filter_tokens(corpus.docs, words, hot=hot))
    if corpus.bow is not None:
        if hot is None:
            hot = hot_words(corpus.bow.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "df")
        out = out.with_(bow=keep_words(corpus.bow, words, hot))
    return out


def drop_unlabelled(corpus: Corpus, field: str) -> Corpus:
    """F8: categories without a label are removed from ``field``."""
    keep = corpus.categories.where((F.col("field") == field) & F.col("label").isNotNull())
    return subset_categories(corpus, field, keep.select("uri"))


def drop_low_support(corpus: Corpus, field: str, min_support: int) -> Corpus:
    """categories of ``field`` with fewer than ``min_support`` documents are removed."""
    s = support(corpus, field).where(F.col("support") >= min_support)
    return subset_categories(corpus, field, s.select("uri"))


def drop_unassigned(corpus: Corpus) -> Corpus:
    """documents with no category in any target are removed."""
    return subset_docs(corpus, corpus.assignments.select("doc_id"))


def categories_in_set(corpus: Corpus, field: str, ids: DataFrame) -> Corpus:
    """keep categories of ``field`` whose uri is in ``ids(uri)``."""
    return subset_categories(corpus, field, ids.select("uri"))


def docs_with_label(corpus: Corpus, prefix: str, labels: DataFrame) -> Corpus:
    """keep documents whose ``prefix + doc_id`` has a non-NULL label."""
    return subset_docs(corpus, ids_with_label(corpus.docs, prefix, labels).select(F.col("uri").alias("doc_id")))


def ids_with_label(ids: DataFrame, prefix: str, labels: DataFrame) -> DataFrame:
    """``(uri)``: the ids of ``ids(doc_id)`` whose ``prefix + doc_id`` has a non-NULL label."""
    lab = labels.where(F.col("label").isNotNull()).select(F.col("uri").alias("__u")).distinct()
    d = ids.select(F.col("doc_id").alias("uri"), F.concat(F.lit(prefix), F.col("doc_id")).alias("__u"))
    return d.join(lab, "__u", "left_semi").select("uri")


def bit_strings(corpus: Corpus, field: str) -> DataFrame:
    """``(doc_id, bits)``: the field's Boolean row as a 0/1 string (export form)."""
    # one row per field: a broadcast bounded by the number of fields
    m = corpus.categories.where(F.col("field") == field).groupBy("field") \
        .agg(F.count(F.lit(1)).alias("m"))
    a = corpus.assignments.where(F.col("field") == field).select("doc_id", "uri")
    c = corpus.categories.where(F.col("field") == field).select(F.col("uri").alias("__cu"),
                                                              F.col("idx").alias("__ci"))
    idxs = (a.join(c, a["uri"].eqNullSafe(c["__cu"])).groupBy("doc_id")
            .agg(F.collect_set("__ci").alias("idxs")))
    d = (corpus.docs.select("doc_id", F.lit(field).alias("field")).join(idxs, "doc_id", "left")
         .join(F.broadcast(m), "field", "left"))
    bits = F.when(F.coalesce(F.col("m"), F.lit(0)) == 0, F.lit("")).otherwise(F.array_join(F.transform(
        F.sequence(F.lit(0), F.col("m") - 1),
        lambda i: F.when(F.array_contains(F.coalesce("idxs", F.array().cast("array<int>")), i),
                         F.lit("1")).otherwise(F.lit("0"))), ""))
    return d.select("doc_id", bits.alias("bits"))
