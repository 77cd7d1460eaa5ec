"""Sharding by a hierarchical weighted hash tree (SQL functions only).

A tree has regions, racks and shards; a node weighs what its leaves weigh together.
Each row descends it: at every level each child draws ``-ln(u) / weight`` with ``u``
hashed from the row's key and the child's id, and the smallest draw wins (a weighted
rendezvous). A child's draw depends on nothing but key, id and weight, so when weights
change, rows move only into subtrees that grew or out of subtrees that shrank.
:func:`grown` adds a shard as a subtree of its own; then no row moves but into it.

Defined results: a null key is a key of its own; rows with equal keys share a shard;
a null text has size 16 and crc32 0; an empty table gives an empty result; columns
other than the named ones are ignored, so names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import HASH_SPAN, hash52, unit, written

#: Rows that one task numbers, at most about.
ROWS_PER_BUCKET = 50_000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, racks: int = 4, per_rack: int = 5) -> list[Leaf]:
    """``shards`` leaves of weight 1, ``per_rack`` to a rack and ``racks`` racks to a region."""
    return [Leaf(s // (racks * per_rack), s // per_rack % racks, s) for s in range(shards)]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, which opens a region of its own."""
    return [*tree, Leaf(max(x.region for x in tree) + 1, 0, max(x.shard for x in tree) + 1, weight)]


def children(tree: list[Leaf], level: int) -> dict[str, dict[str, float]]:
    """Parent id -> {child id: weight} at level 0 (regions), 1 (racks) or 2 (shards)."""
    out: dict[str, dict[str, float]] = {}
    for x in tree:
        ids = ["", f"{x.region}", f"{x.region}/{x.rack}", f"{x.region}/{x.rack}/{x.shard}"]
        kids = out.setdefault(ids[level], {})
        kids[ids[level + 1]] = kids.get(ids[level + 1], 0.0) + x.weight
    return out


def descend(key: Column, tree: list[Leaf]) -> Column:
    """The shard that ``key`` reaches; a leaf of weight 0 gets nothing."""
    at: Column = F.lit("")
    for level in range(3):
        options = [F.struct(F.lit(p).alias("p"), F.array(*[F.struct(F.lit(c).alias("c"), F.lit(w).alias("w"))
                                                           for c, w in kids.items() if w > 0]).alias("kids"))
                   for p, kids in children(tree, level).items() if any(w > 0 for w in kids.values())]
        kids = F.element_at(F.map_from_entries(F.array(*options)), at)
        at = F.array_min(F.transform(kids, lambda x: F.struct(
            (-F.ln(unit(key, x["c"])) / x["w"]).alias("draw"), x["c"].alias("c"))))["c"]
    return F.element_at(F.split(at, "/"), -1).cast("int")


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "slot") -> DataFrame:
    """Gapless numbers from 0 in each group, in the order of the first (hash) column and the rest.

    Each group is cut along the hash into buckets of bounded size; a bucket's numbers start
    where the counts of the buckets before it end. The hash must spread the rows of a group.
    """
    total = rows.count()
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    cut = rows.withColumn("__bucket", F.floor(F.col(order[0]) / F.lit(HASH_SPAN) * F.lit(buckets)).cast("long"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
              .select(group, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    return (cut.withColumn("__at", F.row_number().over(inside))
            .join(starts, [group, "__bucket"])
            .withColumn(name, F.col("__start") + F.col("__at") - F.lit(1))
            .drop("__bucket", "__at", "__start"))


def shard_documents(docs: DataFrame, tree: list[Leaf], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    Slots follow a hash of key, size, crc32 and copy number, so that rows of one hot key
    are still numbered by many tasks; rows equal in the first three are interchangeable
    and are counted before they are moved.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    kinds = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("__copies"))
    placed = written(kinds.select(
        "*", F.lit("key").alias("law"), descend(F.col("doc_id"), tree).alias("shard"),
        descend(F.col("doc_id"), grown(tree)).alias("grown_shard")), "placed")
    # a kind of row takes as many slots as it has copies, each with a hash of its own
    each = (placed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
            .withColumn("__h", hash52(F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("__copy"))))
    return (numbered(each, "shard", ["__h", "doc_id", "size", "text_crc32", "__copy"])
            .select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"),
                    "grown_shard"))
