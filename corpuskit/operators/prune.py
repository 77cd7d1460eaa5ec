"""Joint quality pruning to a fixpoint (G15), by peeling.

Constraints: every document has >= ``min_doc_tokens`` tokens (sum of capped
counts) and >= 1 category; every word occurs in >= ``min_word_docs`` documents;
every category has >= ``min_cat_docs`` documents. All are monotone, so the
greatest sub-corpus meeting them is unique and the order of removal does not matter.

Each document, word and category has counts of what supports it, taken once. What falls
below a threshold is dead; a round sends decrements for the rows of the newly dead only
(a dead document to its words and categories, a dead word or category to its documents), and only what
received a decrement is looked at again. So the bag of words is written once and only read
after that, and what a round writes is as large as what it removes. Decrements to something
that is dead already change nothing.

Boundary rule kept from the original: when the length and support constraints
already hold, nothing is pruned (documents without a category then stay).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.operators.corpus import Corpus, drop_tokens, subset_categories
from corpuskit.operators.hot import hot_words, keep_words
from corpuskit.session import drop_materialized, materialize


def _category(field: Column, uri: Column) -> Column:
    """One key of a category; a NULL uri is a category of its own."""
    return F.to_json(F.struct(field.alias("f"), uri.alias("u")))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _support(corpus: Corpus, bow: DataFrame, assign: DataFrame, thresholds: dict[str, int]) -> DataFrame:
    """``(kind, key, n, cats, least)`` of documents (tokens, categories), words and categories; those without
    support, too. ``cats`` counts a document's categories and is 1 elsewhere."""
    def counted(kind: str, n: DataFrame, cats: DataFrame | None, zero: DataFrame | None) -> DataFrame:
        own = F.lit(0 if kind == "doc" else 1).cast("long")
        rows = [n.select("key", "n", own.alias("cats"))]
        if cats is not None:
            rows.append(cats.select("key", F.lit(0).cast("long").alias("n"), "cats"))
        if zero is not None:
            rows.append(zero.select("key", F.lit(0).cast("long").alias("n"), own.alias("cats")))
        cat = F.sum("cats") if kind == "doc" else F.max("cats")
        whole = rows[0] if len(rows) == 1 else _union(rows).groupBy("key").agg(F.sum("n").alias("n"), cat.alias("cats"))
        return whole.select(F.lit(kind).alias("kind"), "key", "n", "cats", F.lit(thresholds[kind]).cast("long").alias("least"))

    one = F.count(F.lit(1))
    keyed = lambda rows, key: rows.groupBy((F.col(key) if isinstance(key, str) else key).alias("key"))
    return _union([
        counted("doc", keyed(bow, "doc_id").agg(F.sum("n").cast("long").alias("n")),
                keyed(assign, "doc_id").agg(one.alias("cats")), corpus.docs.select(F.col("doc_id").alias("key"))),
        counted("word", keyed(bow, "word").agg(one.alias("n")), None,
                None if corpus.words is None else corpus.words.select(F.col("word").alias("key"))),
        counted("cat", keyed(assign, "cat").agg(one.alias("n")), None,
                corpus.categories.select(_category(F.col("field"), F.col("uri")).alias("key")))])


def prune_fixpoint(corpus: Corpus, min_doc_tokens: int = 10, min_word_docs: int = 5,
                   min_cat_docs: int = 10) -> Corpus:
    """Greatest sub-corpus meeting the constraints (see module doc).

    A round writes one table: what its decrements touch, with all that was lost so far, and
    whether it died of it. The rounds end when nothing dies.
    """
    bow = materialize(corpus.bow.select("doc_id", "word", "n"), "prune_bow")
    assign = materialize(corpus.assignments.select(
        "field", "doc_id", "uri", _category(F.col("field"), F.col("uri")).alias("cat")), "prune_assign")
    support = materialize(_support(corpus, bow, assign, {
        "doc": min_doc_tokens, "word": min_word_docs, "cat": min_cat_docs}), "prune_support")
    if support.where("n < least").isEmpty():
        drop_materialized(bow, assign, support)
        return corpus
    hot = hot_words(support.where("kind = 'word'"), "n", "key")
    dead = support.where("n < least OR cats < 1").select("kind", "key")
    rounds: list[DataFrame] = []
    while True:
        kinds = {r["kind"] for r in dead.select("kind").distinct().collect()}  # of three
        if not kinds:
            break
        # of the first round's words, those that live may be the fewer
        alive = None if rounds else support.where("kind = 'word' AND n >= least AND cats >= 1").select(F.col("key").alias("word"))
        rounds.append(materialize(_round(support, _decrements(bow, assign, dead, kinds, hot, alive), rounds), "prune_round"))
        dead = rounds[-1].where("died").select("kind", "key")
    gone = materialize(_union([support.where("n < least OR cats < 1").select("kind", "key"),
                               *[r.where("died").select("kind", "key") for r in rounds]]), "prune_gone")
    alive = materialize(support.where("kind = 'word'").select(F.col("key").alias("word")).join(
        gone.where("kind = 'word'").select(F.col("key").alias("word")), "word", "left_anti"), "prune_alive")
    drop_materialized(support, *rounds)
    return _without(corpus, bow, assign, gone, hot, alive)


def _round(support: DataFrame, sent: DataFrame, before: list[DataFrame]) -> DataFrame:
    """``(kind, key, lost, lost_cats, died)`` of what received decrements."""
    key = ["kind", "key"]
    if before:  # losses only grow: the largest is the last
        last = _union(before).groupBy(*key).agg(F.max("lost").alias("was"), F.max("lost_cats").alias("was_cats"))
        sent = sent.join(last, key, "left").na.fill(0, ["was", "was_cats"])
    else:
        sent = sent.withColumn("was", F.lit(0)).withColumn("was_cats", F.lit(0))
    short = lambda lost, cats: (F.col("n") - lost < F.col("least")) | (F.col("cats") - cats < 1)
    lost, lost_cats = F.col("was") + F.col("less"), F.col("was_cats") + F.col("less_cats")
    return sent.join(support, key).select(*key, lost.alias("lost"), lost_cats.alias("lost_cats"), (
        short(lost, lost_cats) & ~short(F.col("was"), F.col("was_cats"))).alias("died"))


def _decrements(bow: DataFrame, assign: DataFrame, dead: DataFrame, kinds: set[str], hot: list[str],
                alive: DataFrame | None = None) -> DataFrame:
    """``(kind, key, less, less_cats)``: what the newly dead take from the counts of others."""
    of = lambda kind, name: dead.where(F.col("kind") == kind).select(F.col("key").alias(name))

    def sent(rows: DataFrame, kind: str, key: str, less, less_cats) -> DataFrame:
        return rows.groupBy(F.lit(kind).alias("kind"), F.col(key).alias("key")).agg(
            F.sum(less).cast("long").alias("less"), F.sum(less_cats).cast("long").alias("less_cats"))

    one, none, parts = F.lit(1), F.lit(0), []
    if "doc" in kinds:
        parts += [sent(bow.join(of("doc", "doc_id"), "doc_id", "left_semi"), "word", "word", one, none),
                  sent(assign.join(of("doc", "doc_id"), "doc_id", "left_semi"), "cat", "cat", one, none)]
    if "word" in kinds:  # a frequent word that lives sends nothing: its rows stay out of the join's shuffle
        parts.append(sent(keep_words(bow, of("word", "word"), hot, others=alive), "doc", "doc_id", F.col("n"), none))
    if "cat" in kinds:
        parts.append(sent(assign.join(of("cat", "cat"), "cat", "left_semi"), "doc", "doc_id", none, one))
    return _union(parts).groupBy("kind", "key").agg(F.sum("less").alias("less"), F.sum("less_cats").alias("less_cats"))


def _without(corpus: Corpus, bow: DataFrame, assign: DataFrame, gone: DataFrame, hot: list[str],
             alive: DataFrame) -> Corpus:
    of = lambda kind, name: gone.where(F.col("kind") == kind).select(F.col("key").alias(name))
    docs, words, cats = of("doc", "doc_id"), of("word", "word"), of("cat", "cat")
    assign = assign.join(docs, "doc_id", "left_anti").join(cats, "cat", "left_anti").drop("cat")
    out = corpus.with_(docs=corpus.docs.join(docs, "doc_id", "left_anti"), assignments=assign)
    for f in corpus.fields:
        own = corpus.categories.where(F.col("field") == f).select("uri", _category(F.lit(f), F.col("uri")).alias("cat"))
        out = subset_categories(out, f, own.join(cats, "cat", "left_anti").select("uri"))
    out = out.with_(assignments=assign, bow=keep_words(bow.join(docs, "doc_id", "left_anti"), words, hot, keep=False, others=alive))
    if corpus.words is not None:
        out = out.with_(words=corpus.words.join(words, "word", "left_anti"))
    if "tokens" in corpus.docs.columns:
        out = out.with_(docs=drop_tokens(out.docs, words, hot=hot))
    return out
