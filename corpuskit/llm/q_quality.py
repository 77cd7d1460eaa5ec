"""Queries: quality rules, quality classifier, PII."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.llm import isolation_rules, surrogates, zstd_classifier
from corpuskit.llm.common import table
from corpuskit.llm.registry import query

#: A deployment passes its own secret; this one keeps test results the same.
PII_SECRET = "corpuskit"


@query("op1_isolation_rules")
def op1_isolation_rules(spark, sf_dir):
    done = isolation_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", F.col("path"))


@query("op3_zstd_classifier")
def op3_zstd_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = zstd_classifier.fit(docs, labels)
    return zstd_classifier.score(docs.select("doc_id", "text"), model).select(
        "doc_id", zstd_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op8_surrogates")
def op8_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymize(docs, PII_SECRET)
