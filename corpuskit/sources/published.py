"""Published CSV triple (A6) and its import.

``<name>_data``: ``uuid, text, editorially_confirmed, <field>..., <field>_test-set...``
with each target as a 0/1 bit string over the field's categories;
``<name>_metadata``: ``field, index, uri, label``;
``<name>_processed_text``: ``uuid, processed_text (JSON array), language``.
Each is a CSV directory (one part per task). Texts contain newlines, so reads use
``multiLine`` and ``"`` as quote and escape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.operators.corpus import Corpus, bit_strings

TEST_SUFFIX = "_test-set"
_CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def data_frame(corpus: Corpus, order: DataFrame | None = None) -> DataFrame:
    """A6a as a DataFrame (``ord`` kept when an order ``(doc_id, ord)`` is given)."""
    d = corpus.docs
    cols = [F.col("doc_id").alias("uuid"), F.col("raw_text").alias("text"),
            F.col("editor").cast("int").alias("editorially_confirmed")]
    out = d.select("doc_id", *cols[1:], "test_fields")
    for f in corpus.fields:
        b = bit_strings(corpus, f).withColumnRenamed("bits", f)
        out = out.join(b, "doc_id", "left")
    for f in corpus.fields:
        out = out.withColumn(f + TEST_SUFFIX,
                             F.coalesce(F.array_contains("test_fields", f), F.lit(False)).cast("int"))
    sel = ["uuid", "text", "editorially_confirmed"] + list(corpus.fields) + \
          [f + TEST_SUFFIX for f in corpus.fields]
    out = out.withColumnRenamed("doc_id", "uuid")
    if order is not None:
        out = out.join(order.select(F.col("doc_id").alias("uuid"), "ord"), "uuid", "left")
        sel = sel + ["ord"]
    return out.select(*[F.col(f"`{c}`") for c in sel])


def metadata_frame(corpus: Corpus) -> DataFrame:
    """A6b."""
    return corpus.categories.select("field", F.col("idx").alias("index"), "uri", "label")


def tokens_frame(corpus: Corpus) -> DataFrame:
    """A6c (JSON array for the tokens)."""
    lang = F.col("language") if "language" in corpus.docs.columns else F.lit(None).cast("string")
    return corpus.docs.select(F.col("doc_id").alias("uuid"),
                              F.to_json("tokens").alias("processed_text"), lang.alias("language"))


def publish(corpus: Corpus, target_dir: str, name: str, order: DataFrame | None = None) -> dict[str, str]:
    """Write the two or three CSV datasets; returns their paths."""
    paths = {"data": f"{target_dir}/{name}_data.csv", "metadata": f"{target_dir}/{name}_metadata.csv"}
    df = data_frame(corpus, order)
    if order is not None:
        df = df.orderBy("ord").drop("ord")
    df.write.mode("overwrite").options(**_CSV).csv(paths["data"])
    metadata_frame(corpus).orderBy("field", "index").write.mode("overwrite").options(**_CSV) \
        .csv(paths["metadata"])
    if "tokens" in corpus.docs.columns:
        paths["processed_text"] = f"{target_dir}/{name}_processed_text.csv"
        tokens_frame(corpus).write.mode("overwrite").options(**_CSV).csv(paths["processed_text"])
    return paths


def ones_of(bits: Column) -> Column:
    """Positions (from 0) of the ones of a bit string, found inside its row."""
    chars = F.split(F.coalesce(bits, F.lit("")), "", -1)
    return F.get(F.transform(F.array(chars), lambda c: F.filter(
        F.sequence(F.lit(0), F.size(c) - 1), lambda i: F.get(c, i) == "1")), 0)


def import_published(spark: SparkSession, data_file: str, metadata_file: str,
                     processed_text_file: str | None = None) -> Corpus:
    """Rebuild a corpus from the published CSV datasets."""
    raw = spark.read.options(**_CSV).csv(data_file)
    cols = raw.columns
    test_cols = [c for c in cols if c.endswith(TEST_SUFFIX)]
    fields = tuple(c for c in cols if c not in {"uuid", "text", "editorially_confirmed"}
                   and c not in test_cols)
    meta = spark.read.options(**_CSV).csv(metadata_file).select(
        "field", F.col("index").cast("int").alias("idx"), "uri", "label")
    test_flags = F.filter(F.array(*[F.when(F.col(f"`{f}{TEST_SUFFIX}`") == "1", F.lit(f))
                                    for f in fields]), lambda x: x.isNotNull()) \
        if fields else F.array().cast("array<string>")
    docs = raw.select(F.col("uuid").alias("doc_id"), F.col("text").alias("raw_text"),
                      (F.col("editorially_confirmed") == "1").alias("editor"),
                      test_flags.alias("test_fields"))
    parts = []
    for f in fields:
        ones = raw.select(F.col("uuid").alias("doc_id"), F.explode(ones_of(F.col(f"`{f}`"))).alias("idx"))
        m = meta.where(F.col("field") == f)
        parts.append(ones.join(m, "idx").select(F.lit(f).alias("field"), "doc_id", "uri"))
    if parts:
        assignments = parts[0]
        for p in parts[1:]:
            assignments = assignments.unionByName(p)
    else:
        assignments = spark.createDataFrame([], "field string, doc_id string, uri string")
    corpus = Corpus(docs=docs, assignments=assignments, categories=meta.where(
        F.col("field").isin(*fields)) if fields else meta.limit(0), fields=fields)
    if processed_text_file:
        pt = spark.read.options(**_CSV).csv(processed_text_file).select(
            F.col("uuid").alias("doc_id"),
            F.from_json("processed_text", "array<string>").alias("tokens"), "language")
        corpus = corpus.with_(docs=docs.join(pt, "doc_id", "left"))
    return corpus
