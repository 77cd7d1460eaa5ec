"""Driver tables -> record views the operators consume (see FIXTURES.md §3).

Every view is derived by Spark from the parquet tables, so its size follows the
scale factor. Records are built as JSON text and parsed into VARIANT, so the path
compiler sees real mixed shapes (a field that is a scalar in one record and a list
in the next, lists mixing strings and objects, missing keys, JSON nulls).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.session import staging_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# --- fixed values of the fixture records -------------------------------------
TAXON_PREFIX = "http://x/t/"
URI_PREFIX = "http://x/"
LONG_LANGUAGE_CODES = {"de": "de_DE", "en": "en_US", "es": "es_ES", "fr": "fr_FR"}
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over as many partitions as ``spark.corpuskit.recordPartitions`` says, if set.

    Record building and path walks are CPU-heavy per row; a table of one file would
    otherwise run in one task. Unset, scans keep their own splits and get no shuffle.
    """
    n = df.sparkSession.conf.get("spark.corpuskit.recordPartitions", None)
    return df if n is None else df.repartition(int(n))


def _jstr(c: Column) -> Column:
    """JSON string literal for a string column (``null`` for NULL)."""
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


def _empty() -> Column:
    return F.array().cast("array<string>")


def rec_docs_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, json)``: one catalogue record per document, under ``_source``."""
    docs = spread(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = F.col("doc_id")
    lang = F.col("lang")
    long_code = F.coalesce(*[F.when(lang == k, F.lit(v)) for k, v in LONG_LANGUAGE_CODES.items()],
                           lang)
    lang_code = F.when(d % 5 == 0, long_code).otherwise(lang)
    lang_json = F.when(d % 2 == 0, _jstr(lang_code)).otherwise(
        F.to_json(F.when(d % 7 == 0, F.array(lang_code, F.lit("en"))).otherwise(F.array(lang_code))))
    taxon = F.concat(
        F.array(F.concat(F.lit(TAXON_PREFIX), F.col("source"))),
        F.when(d % 4 == 3, F.array(F.concat(F.lit(TAXON_PREFIX), lang))).otherwise(_empty()),
        F.when(d % 13 == 0, F.array(F.lit(""))).otherwise(_empty()),
        F.when(d % 29 == 0, F.array(F.lit(None).cast("string"))).otherwise(_empty()))
    first_coll = F.to_json(F.struct(
        F.struct(F.array(F.when(d % 4 == 1, F.lit("GROUP_EVERYONE")).otherwise(F.lit("group")))
                 .alias("Read")).alias("permissions"),
        F.struct(F.when(d % 5 == 2, F.lit("Redaktionsbuffet")).otherwise(F.col("source"))
                 .alias("cm:title"),
                 # a collection's id is the id of the record that describes it
                 (d - d % 30 + 2).cast("string").alias("sys:node-uuid")).alias("properties")))
    second_coll = F.to_json(F.struct(F.struct(lang.alias("cm:title"),
                                              lang.alias("sys:node-uuid")).alias("properties")))
    collections = F.concat(F.lit("["), _jstr(F.concat(F.lit("c"), F.col("source"))), F.lit(","),
                           first_coll,
                           F.when(d % 3 == 0, F.concat(F.lit(","), second_coll)).otherwise(F.lit("")),
                           F.lit("]"))
    props = F.struct(
        F.when(d % 23 != 0, F.substring("text", 1, 40)).alias("cclom:title"),
        F.when(d % 11 == 0, _empty()).otherwise(F.array("text")).alias("cclom:general_description"),
        F.parse_json(lang_json).alias("cclom:general_language"),
        F.when(d % 19 == 0, F.lit("other")).otherwise(F.lit("mds_oeh")).alias("cm:edu_metadataset"),
        taxon.alias("ccm:taxonid"),
        F.when(d % 6 == 0, F.array(F.lit("properties.ccm:taxonid"))).alias("ccm:oeh_ai_test_data"),
        F.col("quality").alias("quality"))
    source = F.struct(
        F.struct(d.cast("string").alias("id"),
                 F.struct(F.when(d % 10 == 0, F.lit("archive")).otherwise(F.lit("workspace"))
                          .alias("protocol")).alias("storeRef")).alias("nodeRef"),
        F.when(d % 17 == 0, F.lit("ccm:map")).otherwise(F.lit("ccm:io")).alias("type"),
        F.when(d % 3 == 1, _empty()).when(d % 3 == 2, F.array(F.lit("ccm:collection")))
        .alias("aspects"),
        props.alias("properties"),
        F.struct(F.array(F.when(d % 4 == 0, F.lit("GROUP_EVERYONE")).otherwise(F.lit("owner")))
                 .alias("Read")).alias("permissions"),
        F.parse_json(collections).alias("collections"))
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id", F.to_json(F.struct(source.alias("_source"))).alias("json")))


def rec_docs(spark: SparkSession, sf_dir: str, rooted: bool = True) -> DataFrame:
    """``(doc_id, v VARIANT)``; ``rooted`` re-roots at ``_source`` like the scan does."""
    df = rec_docs_json(spark, sf_dir).select("doc_id", F.parse_json("json").alias("v"))
    if rooted:
        df = df.select("doc_id", F.try_variant_get("v", "$._source", "variant").alias("v"))
    return df


def staged_json_lines(spark: SparkSession, sf_dir: str, name: str, frame: DataFrame) -> str:
    """Write ``frame.json`` as JSON lines below the checkpoint folder; return the path.

    Each call stages anew, so a dump never shows an older state of its table.
    """
    path = staging_path(spark, "staged", name, unique=True)
    frame.select(F.col("json").alias("value")).write.text(path)
    return path


def rec_docs_file(spark: SparkSession, sf_dir: str) -> str:
    return staged_json_lines(spark, sf_dir, "rec_docs", rec_docs_json(spark, sf_dir))


def rec_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, v)``: ``{conv, turns: [{role, text}, ...]}`` ordered by turn."""
    conv = table(spark, sf_dir, "conversations")
    turns = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))),
                        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return (conv.groupBy("conv_id")
            .agg(F.to_json(F.struct(F.col("conv_id").alias("conv"), turns.alias("turns")))
                 .alias("json"))
            .select("conv_id", F.parse_json("json").alias("v")))


def rec_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, v)``: ``{event_id, event_type, props: {k}}``."""
    ev = spread(table(spark, sf_dir, "events"))
    return ev.select("event_id", F.parse_json(F.to_json(F.struct(
        "event_id", "event_type", F.parse_json("props").alias("props")))).alias("v"))


def hier_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary fragments: one path-shaped SKOS tree per customer.

    ``{id: root, hasTopConcept: [{id: r<k>, prefLabel: {de}, narrower: [{id: n<k>, ...,
    narrower: [{id: c<k>, prefLabel: {de}}]}]}]}``. The union of the fragments is the
    vocabulary region -> nation -> customer; each fragment stays small.
    """
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    # nation and region are fixed-size dimension tables: broadcasting them is bounded
    j = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey) \
        .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey)
    leaf = F.struct(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"),
                    F.struct(F.col("c_name").alias("de")).alias("prefLabel"))
    nat = F.struct(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
                   F.struct(F.col("n_name").alias("de")).alias("prefLabel"),
                   F.array(leaf).alias("narrower"))
    reg = F.struct(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"),
                   F.struct(F.col("r_name").alias("de")).alias("prefLabel"),
                   F.array(nat).alias("narrower"))
    root = F.struct(F.lit("root").alias("id"), F.array(reg).alias("hasTopConcept"))
    return j.select(F.col("c_custkey").alias("frag_id"), F.to_json(root).alias("json"))


def hier_file(spark: SparkSession, sf_dir: str) -> str:
    return staged_json_lines(spark, sf_dir, "hier", hier_json(spark, sf_dir))


def brand_vocabulary_file(spark: SparkSession, sf_dir: str) -> str:
    """A second vocabulary: one fragment per labelled brand, below one scheme."""
    brand = F.struct(F.col("uri").alias("id"), F.struct(F.col("label").alias("de")).alias("prefLabel"))
    tree = F.struct(F.lit("brands").alias("id"), F.array(brand).alias("hasTopConcept"))
    frame = uri_labels(spark, sf_dir).select(F.regexp_replace("uri", r"\.html$", "").alias("uri"), "label")
    return staged_json_lines(spark, sf_dir, "brands", frame.select(F.to_json(tree).alias("json")))


def staged_vocabularies(spark: SparkSession, sf_dir: str, address: str) -> str:
    """A folder of staged vocabularies that has the taxon concepts, one document, at ``address``."""
    from corpuskit.operators.vocab import staged_path

    root = staging_path(spark, "vocabularies", unique=True)
    concept = F.struct(F.col("uri").alias("id"), F.struct(F.col("label").alias("de")).alias("prefLabel"))
    one = source_labels(spark, sf_dir).agg(F.collect_list(concept).alias("narrower"))
    tree = F.struct(F.lit("scheme").alias("id"), F.array(F.struct(F.lit("all").alias("id"), "narrower")).alias("hasTopConcept"))
    one.select(F.to_json(tree).alias("value")).coalesce(1).write.text(staged_path(root, address))
    return root


def uri_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged ``(uri, label)`` for brand concepts; brands ending in 3 have no entry."""
    part = table(spark, sf_dir, "part")
    return (part.select("p_brand").distinct()
            .where(~F.col("p_brand").endswith("3"))
            .select(F.concat(F.lit(URI_PREFIX), F.col("p_brand"), F.lit(".html")).alias("uri"),
                    F.col("p_brand").alias("label")))


def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged ``(uri, label)`` for the taxon concepts of the record view.

    Sources get a label; the language concepts get none (so they are unlabelled).
    """
    docs = table(spark, sf_dir, "documents")
    return (docs.select("source").distinct()
            .select(F.concat(F.lit(TAXON_PREFIX), F.col("source")).alias("uri"),
                    F.upper(F.col("source")).alias("label")))


def topic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged ``(uri, label)`` topics over record ids: every other group of 30 records has one."""
    d = F.col("doc_id")
    return (table(spark, sf_dir, "documents").where(F.floor(d / 30) % 2 == 0)
            .select(F.concat(F.lit(TAXON_PREFIX), d.cast("string")).alias("uri"),
                    F.concat(F.lit("topic "), F.col("source")).alias("label")))


def tok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, pos, word)`` by the token pattern."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(TOKEN_PATTERN), 0))
                       .alias("pos", "word"))


def assign_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id STRING, uri STRING)``: distinct brands per order (25-category target)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    pairs = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_brand").distinct()  # by the short key
    return pairs.select(F.col("l_orderkey").cast("string").alias("doc_id"), F.col("p_brand").alias("uri"))


def preds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(docs, truth, pred)`` for the classification report.

    truth labels: ``quality`` / ``toxic`` from ``labels``; predictions: a rule on
    ``n_chars`` and ``source``. ``docs`` is every labelled document.
    """
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    base = labels.join(docs, "doc_id", "left")
    truth = base.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.concat(
        F.when(F.col("quality") == 1, F.array(F.lit("quality"))).otherwise(_empty()),
        F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(_empty()))).alias("label"))
    pred = base.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.concat(
        F.when(F.col("n_chars") > 2000, F.array(F.lit("quality"))).otherwise(_empty()),
        F.when(F.col("source").isin("src1", "src3", "src5"), F.array(F.lit("toxic")))
        .otherwise(_empty()))).alias("label"))
    return base.select(F.col("doc_id").cast("string").alias("doc_id")), truth, pred


def single_label_preds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(truth(doc_id, label), pred(doc_id, label))``, one label per document."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    base = labels.join(docs, "doc_id", "left")
    truth = base.select(F.col("doc_id").cast("string").alias("doc_id"),
                        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
                        .otherwise("poor").alias("label"))
    pred = base.select(F.col("doc_id").cast("string").alias("doc_id"),
                       F.when(F.col("source").isin("src1", "src3", "src5"), "toxic")
                       .when(F.col("n_chars") > 2000, "good").otherwise("poor").alias("label"))
    return truth, pred


def review_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(visited, accepted)`` id lists over orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    ids = orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("doc_id"))
    return (ids.where(F.col("k") % 7 == 0).select("doc_id"),
            ids.where(F.col("k") % 21 == 0).select("doc_id"))
