"""Controlled vocabularies (E1-E6) from staged SKOS-like JSON documents.

Vocabulary documents are nested concept trees (``hasTopConcept`` / ``narrower``).
They may be one document or many fragments whose union is the vocabulary; either
way the expansion goes level by level, one row per (node occurrence), so no node
list is gathered in one place. Outputs are edge tables rather than per-node lists.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions.paths import split_path
from corpuskit.session import materialize
from corpuskit.sources.records import read_vocabulary

SUBCATEGORY_FIELDS = ("narrower", "hasTopConcept")


def _json_path(seq: Sequence[str]) -> str:
    """JSONPath with double-quoted keys (embedded in single-quoted SQL literals)."""
    for k in seq:
        if '"' in k or "'" in k or "\\" in k:
            raise ValueError(f"unsupported vocabulary key: {k!r}")
    return "$" + "".join('["' + k + '"]' for k in seq)


#: Levels that one pass walks inside a document's row.
LEVELS = 8
_NODE = "struct<id:string,label:string,parent:string,depth:int,node:variant>"


def concept_nodes(vocab: DataFrame, id_seq: Sequence[str] | str = ("id",),
                  label_seq: Sequence[str] | str = ("prefLabel", "de"),
                  subcategory_fields: Sequence[str] = SUBCATEGORY_FIELDS, col: str = "v",
                  keep: Sequence[str] = ()) -> DataFrame:
    """``(id, label, parent, depth)`` for every node occurrence reachable through
    the subcategory fields (roots have NULL parent), with the columns ``keep`` of its document.

    A document is walked inside its row, LEVELS levels at a time. The nodes found are written once,
    with the sub-trees below them if there are any; the next pass goes on from these. A JSON tree is
    finite, so no depth limit is needed.
    """
    id_seq = split_path(id_seq) if isinstance(id_seq, str) else tuple(id_seq)
    label_seq = split_path(label_seq) if isinstance(label_seq, str) else tuple(label_seq)
    idp, labp = _json_path(id_seq), _json_path(label_seq)
    none = F.array().cast("array<variant>")
    text = lambda x, path: F.try_variant_get(x, path, "string")

    def kids(x: Column) -> Column:
        return F.concat(*[F.coalesce(F.try_variant_get(x, _json_path([f]), "array<variant>"), none) for f in subcategory_fields])

    def node(id_, label, parent, depth, tree) -> Column:
        return F.struct(id_.alias("id"), label.alias("label"), parent.alias("parent"), depth.cast("int").alias("depth"), tree.alias("node"))

    null, no_tree = F.lit(None).cast("string"), F.lit(None).cast("variant")

    def level(acc: Column, _) -> Column:
        here = F.transform(acc["open"], lambda o: node(text(o["node"], idp), text(o["node"], labp), o["parent"], o["depth"], no_tree))
        below = F.flatten(F.transform(acc["open"], lambda o: F.transform(
            kids(o["node"]), lambda k: node(null, null, text(o["node"], idp), o["depth"] + 1, k))))
        return F.struct(F.concat(acc["found"], here).alias("found"), below.alias("open"))

    trees = vocab.where(F.col(col).isNotNull()).select(*keep, node(null, null, null, F.lit(0), F.col(col)).alias("n"))
    found = []
    while True:
        start = F.struct(F.array().cast(f"array<{_NODE}>").alias("found"), F.array("n").alias("open"))
        walked = trees.select(*keep, F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, level).alias("w"))
        rows = materialize(walked.select(*keep, F.explode(F.concat("w.found", "w.open")).alias("n")), "concepts")
        found.append(rows.where("n.node IS NULL").select(*keep, "n.id", "n.label", "n.parent", "n.depth"))
        trees = rows.where("n.node IS NOT NULL")
        if trees.isEmpty():
            return reduce(DataFrame.unionByName, found)


def children_map(nodes: DataFrame) -> DataFrame:
    """``(id, child)`` edges; a node without children has one row with NULL child."""
    edges = nodes.where(F.col("parent").isNotNull()).select(F.col("parent").alias("id"),
                                                           F.col("id").alias("child")).distinct()
    ids = nodes.select("id").distinct()
    leaves = ids.join(edges.select("id"), "id", "left_anti").select(
        "id", F.lit(None).cast("string").alias("child"))
    return edges.unionByName(leaves)


def parent_map(nodes: DataFrame) -> DataFrame:
    """``(id, parent)`` for every non-root id; with several parents the one met
    at the smallest depth wins, then the smallest id (deterministic)."""
    e = nodes.where(F.col("parent").isNotNull())
    return e.groupBy("id").agg(F.min_by("parent", F.struct("depth", "parent")).alias("parent"))


def label_table(nodes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(id, label)`` for every node that has a label; one row per id
    (duplicates: smallest depth, then label), in each group of the columns ``by``."""
    e = nodes.where(F.col("id").isNotNull() & F.col("label").isNotNull())
    return e.groupBy(*by, "id").agg(F.min_by("label", F.struct("depth", "label")).alias("label"))


def labels_for_ids(rows: DataFrame, ids_col: str, labels: DataFrame, out_col: str = "label",
                   multi_value: bool | None = None, key: str | None = None) -> DataFrame:
    """Look up labels for a single id column or an array of ids.

    Unknown ids give NULL labels; a NULL input gives NULL output. For arrays the
    order is kept and unknown entries stay as NULL elements; ``key`` names the
    unique row key used to gather the looked-up labels back (one small group per row).
    """
    dtype = dict(rows.dtypes)[ids_col]
    if multi_value is None:
        multi_value = dtype.startswith("array")
    lab = labels.select(F.col("id").alias("__lid"), F.col("label").alias("__lab"))
    if not multi_value:
        return (rows.join(lab, rows[ids_col] == lab["__lid"], "left")
                .withColumn(out_col, F.col("__lab")).drop("__lid", "__lab"))
    if key is None:
        raise ValueError("multi-valued lookup needs a unique row key")
    ex = rows.select(F.col(key).alias("__rk"), F.posexplode(ids_col).alias("__pos", "__id"))
    looked = ex.join(lab, ex["__id"] == lab["__lid"], "left").groupBy("__rk").agg(
        F.sort_array(F.collect_list(F.struct("__pos", "__lab"))).alias("__l"))
    looked = looked.select("__rk", F.transform("__l", lambda s: s["__lab"]).alias("__labels"))
    out = rows.join(looked, rows[key] == looked["__rk"], "left")
    return (out.withColumn(out_col, F.when(F.col(ids_col).isNull(), F.lit(None))
                           .otherwise(F.coalesce("__labels", F.array().cast("array<string>"))))
            .drop("__rk", "__labels"))


def normalise_uri(c) -> "F.Column":
    """Concept URIs are looked up as ``.json``: strip ``.html``, add ``.json``."""
    stripped = F.regexp_replace(c, r"\.html$", "")
    return F.when(stripped.endswith(".json"), stripped).otherwise(F.concat(stripped, F.lit(".json")))


def labels_by_uri(uris: DataFrame, uri_col: str, staged: DataFrame, out_col: str = "label") -> DataFrame:
    """E5: label per URI from a staged ``(uri, label)`` table; empty/unknown -> NULL.

    Each distinct URI is normalised and joined once; results are joined back.
    """
    st = staged.select(normalise_uri(F.col("uri")).alias("__n"), F.col("label").alias("__lab")) \
        .groupBy("__n").agg(F.min("__lab").alias("__lab"))
    distinct = uris.select(F.col(uri_col).alias("__u")).distinct().where(
        F.col("__u").isNotNull() & (F.col("__u") != ""))
    looked = distinct.withColumn("__n", normalise_uri(F.col("__u"))).join(st, "__n", "left") \
        .select("__u", "__lab")
    return (uris.join(looked, uris[uri_col] == looked["__u"], "left")
            .withColumn(out_col, F.col("__lab")).drop("__u", "__lab"))


def hierarchy(nodes: DataFrame) -> DataFrame:
    """``(name, key, parent)`` for every labelled id; parent NULL for roots."""
    labels = label_table(nodes)
    parents = parent_map(nodes)
    return labels.join(parents, "id", "left").select(
        F.col("label").alias("name"), F.col("id").alias("key"), "parent")


def label_lookup_table(nodes: DataFrame) -> DataFrame:
    """``(uri, label)`` view of a label table, for category labelling."""
    return label_table(nodes).select(F.col("id").alias("uri"), "label")


def staged_path(root: str, address: str) -> str:
    """Where the vocabulary of a web address is staged: below ``root``, by host and path. A path stays as it is."""
    return f"{root.rstrip('/')}/{address.split('://', 1)[1]}" if address.startswith(("http://", "https://")) else address


def registry_labels(spark: SparkSession, registry: Mapping[str, str], root: str = "", label_seq="prefLabel.de",
                    multiline: bool = True) -> DataFrame:
    """``(field, uri, label)`` of all vocabularies of a registry ``field -> address``, in one walk.

    Addresses on the web are staged files below ``root`` (:func:`staged_path`).
    """
    docs = [read_vocabulary(spark, staged_path(root, address), multiline=multiline).select(F.lit(field).alias("field"), "v")
            for field, address in registry.items()]
    if not docs:
        return spark.createDataFrame([], "field string, uri string, label string")
    nodes = concept_nodes(reduce(DataFrame.unionByName, docs), label_seq=label_seq, keep=("field",))
    return label_table(nodes, by=("field",)).select("field", F.col("id").alias("uri"), "label")


__all__ = ["concept_nodes", "children_map", "parent_map", "label_table", "labels_for_ids",
           "labels_by_uri", "hierarchy", "registry_labels", "staged_path", "normalise_uri", "label_lookup_table"]
