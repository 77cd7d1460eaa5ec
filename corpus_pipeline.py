"""From raw documents to piece ids: classify, deduplicate, replace personal data, mix, encode.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``; ``sf_dir`` is read for labels only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import bag_minhash, poisson_mix, sentence_pieces, surrogates, zstd_classifier
from corpuskit.llm.common import table, written
from corpuskit.llm.q_native import MIX_SEED
from corpuskit.llm.q_quality import PII_SECRET
from corpuskit.llm.q_text import PIECES


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    model = zstd_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return zstd_classifier.score(docs, model).where("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bag_minhash.keep_one_of_each(docs).select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the new text."""
    done = surrogates.pseudonymize(docs, PII_SECRET)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by a Poisson draw with each source's target rate, in global random order."""
    return poisson_mix.poisson_mix(docs, poisson_mix.rates_by_power(docs), seed=MIX_SEED).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every copy, and whether they decode to its text."""
    return sentence_pieces.encode_documents(docs, PIECES, keep=("doc_id", "lang", "source"), back=True).drop("decoded")


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup), ("PII", private),
          ("mixing to target weights", mix), ("SentencePiece", pieces)]

#: A learned classifier, signatures and piece ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
