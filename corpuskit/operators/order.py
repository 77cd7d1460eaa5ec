"""Ordering and review queues (H1-H6).

Orders are total (document id last) so every position is reproducible; global
positions come from ``with_ordinal`` (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.operators.corpus import Corpus, labels_per_doc, support
from corpuskit.operators.ordinal import top_k_per_group, with_ordinal


def sort_editor(corpus: Corpus) -> DataFrame:
    """H1: ``(doc_id, editor, ord)`` confirmed documents first."""
    d = corpus.docs.select("doc_id", "editor")
    return with_ordinal(d, [F.desc("editor"), F.asc("doc_id")], "ord")


def sort_collections(corpus: Corpus, field: str) -> DataFrame:
    """H2: ``(doc_id, n, ord)`` by number of categories of ``field``, descending."""
    n = labels_per_doc(corpus, field)
    return with_ordinal(n, [F.desc("n"), F.asc("doc_id")], "ord")


def sort_len(corpus: Corpus, field: str) -> DataFrame:
    """H3: ``(doc_id, n_tokens, n, ord)``: token count descending, ties ascending in H2's key."""
    n = labels_per_doc(corpus, field)
    d = corpus.docs.select("doc_id", F.size("tokens").alias("n_tokens")).join(n, "doc_id")
    return with_ordinal(d, [F.desc("n_tokens"), F.asc("n"), F.asc("doc_id")], "ord")


def _accepted_counts(corpus: Corpus, field: str, accepted: DataFrame) -> DataFrame:
    acc = corpus.with_(assignments=corpus.assignments.join(accepted.select("doc_id"), "doc_id",
                                                           "left_semi"))
    return support(acc, field).select("uri", "idx", "label", F.col("support").alias("accepted"))


def _relevant(corpus: Corpus, field: str, positions: DataFrame, visited: DataFrame) -> DataFrame:
    a = corpus.assignments.where(F.col("field") == field)
    return (a.join(visited.select("doc_id"), "doc_id", "left_anti")
            .join(positions.select("doc_id", "ord"), "doc_id"))


def next_candidate(corpus: Corpus, field: str, positions: DataFrame, visited: DataFrame,
                   accepted: DataFrame, max_hits: int) -> DataFrame:
    """H4: the next document to review: for the least-covered category (stable in
    ``idx``) with ``accepted <= max_hits`` that still has an unvisited document,
    that category's unvisited document with the lowest position. One row or none."""
    counts = _accepted_counts(corpus, field, accepted).where(F.col("accepted") <= max_hits)
    rel = _relevant(corpus, field, positions, visited)
    cand = rel.join(counts, rel["uri"].eqNullSafe(counts["uri"])).select(
        "doc_id", rel["uri"], "idx", "accepted", "ord")
    return cand.orderBy("accepted", "idx", "ord").limit(1)


def review_queue(corpus: Corpus, field: str, positions: DataFrame, visited: DataFrame,
                 accepted: DataFrame, max_hits: int) -> DataFrame:
    """H5: per category, the next ``max_hits - accepted`` unvisited documents by position.

    Top-k per category with salting: a hot category is ranked in pieces first.
    """
    counts = _accepted_counts(corpus, field, accepted).where(F.col("accepted") < max_hits)
    rel = _relevant(corpus, field, positions, visited)
    cand = rel.join(counts, rel["uri"].eqNullSafe(counts["uri"])).select(
        "doc_id", rel["uri"], "idx", "label", "accepted", "ord")
    return top_k_per_group(cand, ["idx"], ["ord"], max_hits, salt_key="doc_id", rank_name="rank",
                           bound=F.lit(max_hits) - F.col("accepted"))


def coverage_report(corpus: Corpus, field: str, accepted: DataFrame) -> DataFrame:
    """H6: ``(idx, uri, label, candidates, accepted)`` per category of ``field``."""
    s = support(corpus, field).select("idx", "uri", "label", F.col("support").alias("candidates"))
    acc = _accepted_counts(corpus, field, accepted).select("idx", "accepted")
    return s.join(acc, "idx", "left").select(
        "idx", "uri", "label", "candidates", F.coalesce("accepted", F.lit(0)).alias("accepted"))
