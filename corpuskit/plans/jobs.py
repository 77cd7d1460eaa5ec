"""End-to-end corpus jobs (K1-K7).

The extracted record table is written once to shared storage and read by the document
table and every target, so later steps never walk the records again.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit import fields as FD
from corpuskit.fields import Fields
from corpuskit.functions import predicates as P
from corpuskit.functions.paths import sampled_leaf_paths, t_first_string, t_string, t_value_list, t_vals
from corpuskit.functions.variant import is_string, vstr
from corpuskit.operators import corpus as C
from corpuskit.operators import order as O
from corpuskit.operators import text as T
from corpuskit.operators import split as S
from corpuskit.operators.prune import prune_fixpoint
from corpuskit.operators.vocab import registry_labels
from corpuskit.session import materialize
from corpuskit.sources import published as PUB
from corpuskit.sources.records import extract_table, read_id_list, write_id_list

BASE_COLUMNS = (Fields.TITLE.value, Fields.DESCRIPTION.value, Fields.ID.value,
                Fields.COLLECTIONS_TITLE.value, Fields.LANGUAGE.value, Fields.TEST_DATA.value)


def _alias(path: str) -> str:
    return "__c_" + "".join(ch if ch.isalnum() else "_" for ch in path)


def _has_string(vals, value: str):
    return F.coalesce(F.exists(vals, lambda x: is_string(x) & (vstr(x) == value)), F.lit(False))


def base_corpus(records: DataFrame, target_fields: Sequence[str],
                labels: dict[str, DataFrame] | DataFrame | None = None, skip_labels: bool = False,
                filters: Iterable[P.Filter] = (), dropped_values: dict | None = None,
                remapped_values: dict | None = None, max_len: int | None = None,
                order=None, stage: bool = True, uri_labels: DataFrame | None = None,
                category_order: dict | None = None, vocabulary_root: str | None = None,
                beside: P.Filter | None = None) -> C.Corpus | tuple[C.Corpus, DataFrame]:
    """K1: records (``v`` VARIANT, re-rooted) -> corpus over ``target_fields``.

    The extraction is written once (``stage``), by columns, so that what reads categories only reads no
    texts. Categories take their labels from ``labels``
    (a table ``(field, uri, label)``, or tables ``(uri, label)`` by field), by default from the catalogue's
    vocabularies staged below ``vocabulary_root``; fields without a vocabulary from the staged per-URI
    table ``uri_labels``. ``category_order[field]`` orders a field's categories (Columns over ``uri``).

    With ``beside``, the ids ``(doc_id)`` of the records that this filter accepts are returned, too, from the
    same walk over the records.
    """
    target_fields = tuple(str(f) for f in target_fields)
    spark = records.sparkSession
    paths = list(dict.fromkeys(BASE_COLUMNS + target_fields))
    columns = {_alias(p): p for p in paths}
    filters = list(filters)
    flags = {} if beside is None else {"__main": P.conjunction(filters), "__beside": beside}
    ext = extract_table(records, columns, filters=[P.comp(*flags.values())] if flags else filters, flags=flags,
                        dropped_values=dropped_values, remapped_values=remapped_values, max_len=max_len, order=order)
    t = {p: F.col(_alias(p)) for p in paths}
    title, descr = t_string(t[Fields.TITLE.value]), t_first_string(t[Fields.DESCRIPTION.value])
    raw_text = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(descr, F.lit("")))
    editor = F.coalesce(F.exists(t_vals(t[Fields.COLLECTIONS_TITLE.value]),
                                 lambda x: is_string(x) & (vstr(x) == FD.EDITOR_COLLECTION_TITLE)),
                        F.lit(False))
    test_vals = t_vals(t[Fields.TEST_DATA.value])
    test_fields = F.filter(F.array(*[F.when(_has_string(test_vals, f), F.lit(f))
                                     for f in target_fields]), lambda x: x.isNotNull()) \
        if target_fields else F.array().cast("array<string>")
    ext = ext.select(F.coalesce(t_string(t[Fields.ID.value]), t_first_string(t[Fields.ID.value]))
                     .alias("doc_id"), raw_text.alias("raw_text"), editor.alias("editor"),
                     test_fields.alias("test_fields"),
                     *[t_value_list(t[f]).alias(_alias(f)) for f in target_fields], *flags)
    if stage:
        ext = materialize(ext, "extraction")
    if beside is not None:
        other = ext.where("__beside").select("doc_id")
        ext = ext.where("__main")
    docs = ext.select("doc_id", "raw_text", "editor", "test_fields")
    if not target_fields:
        if beside is not None:
            raise ValueError("a walk beside needs target fields")
        return C.Corpus(docs=docs, assignments=spark.createDataFrame([], "field string, doc_id string, uri string"),
                        categories=spark.createDataFrame([], "field string, idx int, uri string, label string"), fields=())
    assignments = reduce(DataFrame.unionByName, [C.assigned(ext.select("doc_id", F.col(_alias(f)).alias("vals")), f)
                                                 for f in target_fields])
    categories = C.rank_categories(assignments, target_fields, category_order or {})
    if skip_labels:
        labels, uri_labels = None, None
    elif labels is None and vocabulary_root is not None:
        labels = vocabulary_labels(spark, vocabulary_root, target_fields)
    corpus = C.Corpus(docs=docs, assignments=assignments, fields=target_fields,
                      categories=C.label_categories(categories, labels, uri_labels))
    return corpus if beside is None else (corpus, other)


def flat_corpus(records: DataFrame, target_fields: Sequence[str], dropped_values: dict | None = None,
                remapped_values: dict | None = None, filters: Iterable[P.Filter] = (),
                use_defaults: bool = True, **kw) -> C.Corpus:
    """K2: K1 with default repairs and the catalogue, visibility and text filters."""
    dropped_values = dict(dropped_values or {})
    remapped_values = dict(remapped_values or {})
    filters = list(filters)
    if use_defaults:
        dropped_values = FD.merge_defaults(FD.default_dropped_values(), dropped_values)
        remapped_values = FD.merge_defaults(FD.default_remapped_values(), remapped_values)
        filters = [P.public_filter, P.catalogue_filter, P.existing_text_filter] + filters
    return base_corpus(records, target_fields, filters=filters, dropped_values=dropped_values,
                       remapped_values=remapped_values, **kw)


def collections_corpus(records: DataFrame, target_fields: Sequence[str],
                       filters: Iterable[P.Filter] = (), **kw) -> C.Corpus:
    """K3: K1 restricted to collection records."""
    return base_corpus(records, target_fields, filters=list(filters) + [P.collections_filter], **kw)


def vocabulary_labels(spark, root: str, fields: Iterable[str] | None = None, registry: dict[str, str] | None = None,
                      overrides: dict[str, str | None] | None = None, **kw) -> DataFrame:
    """``(field, uri, label)`` for K1 from the vocabularies that are staged below ``root``.

    ``registry`` (by default the catalogue's own) gives each field's vocabulary; ``overrides`` replace
    entries, or leave fields out (None). Only ``fields`` are read, if given.
    """
    known = {**(FD.default_vocabularies() if registry is None else registry), **(overrides or {})}
    wanted = {f: a for f, a in known.items() if a is not None and (fields is None or f in set(fields))}
    return registry_labels(spark, wanted, root, **kw)


def default_pipeline(tagger=T.closed_class_tags, excluded_tags=FD.EXCLUDED_POS_TAGS, tagged_col: str | None = None) -> list[T.TokenStep]:
    """The token steps of the training job.

    ``tagger`` maps a document's tokens to their tags, in Python (see ``text.tag_tokens``). Documents that
    bring ``tagged_col`` from a model of their own are not tagged again.
    """
    if tagged_col is None:
        tag, col = (lambda d: T.tag_tokens(d, tagger)), "tagged"
    else:
        tag, col = (lambda d: d), tagged_col
    return [T.tokenise,
            T.language_vote,  # by the whole text, before words leave it
            tag,
            lambda d: T.repetition_filter(d, min_rep_count=4, post_filter_count=2, col=col, key=lambda x: x["token"]),
            lambda d: T.drop_tags(d.drop("tokens"), excluded_tags, tagged_col=col).drop("tagged"),
            lambda d: materialize(d, "tagged_tokens"),  # read by each step of the next: counts, hot words, filter
            lambda d: T.df_interval(d, min_num=10, max_rate=0.25, interval_open=False)]


def training_corpus(records: DataFrame, target_fields: Sequence[str], filters: Iterable[P.Filter] = (),
                    language: str = "de", pipeline: Iterable[T.TokenStep] | None = None,
                    min_doc_tokens: int = 10, min_word_docs: int = 5, min_cat_docs: int = 10,
                    length_unit: str = "elements", **kw) -> tuple[C.Corpus, DataFrame]:
    """K4: bag-of-words training corpus; returns the corpus and its order (H1).

    ``pipeline`` is a list of steps ``documents -> documents``; the default is
    :func:`default_pipeline`.
    """
    labelled = P.labeled_filter(list(target_fields), multi_field_semantics="any")
    text_len = P.len_filter([Fields.DESCRIPTION.value, Fields.TITLE.value], 30,
                            multi_field_semantics="any", unit=length_unit)
    corpus = flat_corpus(records, target_fields, filters=[labelled, text_len] + list(filters), **kw)
    for f in corpus.fields:
        corpus = C.drop_unlabelled(corpus, f)
    docs = T.run_pipeline(corpus.docs, default_pipeline() if pipeline is None else pipeline)
    corpus = T.keep_language(corpus.with_(docs=docs), language)
    # the token pipeline is the expensive part: write it once, every later branch reads it
    corpus = corpus.with_(docs=materialize(corpus.docs, "training_docs"),
                          assignments=materialize(corpus.assignments, "training_assign"),
                          categories=materialize(corpus.categories, "training_cats"))
    corpus = T.bag_of_words(corpus)
    corpus = T.drop_long_tokens(corpus, 30)
    corpus = prune_fixpoint(corpus, min_doc_tokens, min_word_docs, min_cat_docs)
    return corpus, O.sort_editor(corpus)


def candidates_corpus(records: DataFrame, field: str, topic_labels: DataFrame,
                      topic_prefix: str = "", filters: Iterable[P.Filter] = (),
                      length_unit: str = "elements", **kw) -> tuple[C.Corpus, DataFrame]:
    """K5: test-data candidates for ``field``; returns the corpus and its order (H2, H3).

    ``topic_labels(uri, label)`` is the staged topic vocabulary; a collection is kept
    when ``topic_prefix + collection id`` has a label there. Documents and collections come from
    one walk over the records.
    """
    targets = [field, Fields.COLLECTIONS_UUID.value, Fields.TOPIC.value]
    extra = [P.labeled_filter([field]),
             P.len_filter([Fields.DESCRIPTION.value, Fields.TITLE.value], 50,
                          multi_field_semantics="any", unit=length_unit)]
    corpus, colls = flat_corpus(records, targets, filters=extra + list(filters), beside=P.collections_filter, **kw)
    corpus = corpus.with_(docs=materialize(T.drop_short_sentences(corpus.docs, 6), "candidate_docs"))
    corpus = T.drop_short_docs(corpus, 20)
    corpus = C.categories_in_set(corpus, Fields.COLLECTIONS_UUID.value, C.ids_with_label(colls, topic_prefix, topic_labels))
    return corpus, O.sort_len(corpus, Fields.COLLECTIONS_UUID.value)


def publish_job(corpus: C.Corpus, order: DataFrame, field: str, target_dir: str, ratio: float = 0.3, seed: int = 0,
                train: str = "corpus_train", test: str = "corpus_test") -> tuple[dict, dict]:
    """K6: split ``corpus`` by the categories of ``field`` and publish both parts; their paths."""
    rest, kept = S.balanced_split(corpus, field, ratio, seed)
    return PUB.publish(rest, target_dir, train, order), PUB.publish(kept, target_dir, test, order)


def review_job(corpus: C.Corpus, order: DataFrame, field: str, state_dir: str, max_hits: int) -> tuple[DataFrame, DataFrame]:
    """K7, one round: the review queue of ``field`` and its coverage.

    Reads the lists of visited and accepted ids of earlier rounds from ``state_dir`` and
    writes the ids to review next as ``queue.csv`` there. An unknown field is an error.
    """
    corpus.check_field(field)
    spark = corpus.docs.sparkSession
    visited, accepted = (read_id_list(spark, f"{state_dir}/{n}.csv") for n in ("visited", "accepted"))
    queue = materialize(O.review_queue(corpus, field, order, visited, accepted, max_hits), "queue")
    write_id_list(queue.select("doc_id").distinct(), state_dir + "/queue.csv")
    return queue, O.coverage_report(corpus, field, accepted)


def review_fields(records: DataFrame, key: str, rate: float = 0.1) -> DataFrame:
    """K7, before the first round: the fields ``(path, depth)`` that a reviewer can choose from, shortest first;
    leaf paths of every k-th record (B5)."""
    return sampled_leaf_paths(records, rate, key).orderBy(F.length("path"), "path")


def review_session(records: DataFrame, key: str, field: str, topic_labels: DataFrame, state_dir: str, max_hits: int,
                   rate: float = 0.1, **kw) -> tuple[DataFrame, DataFrame]:
    """K7: discover the fields, check the chosen one against them, build its candidates, run the next round.

    A field that no sampled record has is an error that names the fields with a similar name.
    """
    found = [r["path"] for r in review_fields(records, key, rate).collect()]  # paths of a schema, not of records
    if field not in found:
        near = difflib.get_close_matches(field, found, 3) or found[:3]
        raise ValueError(f"no record has a field {field!r}; similar ones: {', '.join(near)}")
    corpus, order = candidates_corpus(records, field, topic_labels, **kw)
    return review_job(corpus, order, field, state_dir, max_hits)


def record_review(spark, state_dir: str, visited: DataFrame, accepted: DataFrame) -> None:
    """Add the outcome of a round, ``(doc_id)`` each, to the lists that the next round reads."""
    for name, ids in (("visited", visited), ("accepted", accepted)):
        path = f"{state_dir}/{name}.csv"
        # written apart first: the list is read while the new one is written
        new = materialize(read_id_list(spark, path).unionByName(ids.select("doc_id")).distinct(), name)
        write_id_list(new, path)
