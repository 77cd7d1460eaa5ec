"""Category-balanced split.

1. Each document gets a seeded pseudo-random key ``md5(seed:doc_id)`` (I1).
2. Per category, ``target = rint(count * ratio)`` (half-even) (I2).
3. Initial selection: per category, the ``target`` documents with the smallest
   keys (all when the category is smaller) (I3).
4. Greedy surplus removal: walking the selected documents by key, drop a document
   when every one of its categories keeps at least its target without it (I4).
5. ``(rest, kept)`` (I5).

A key is a function of its document, so it is never written or shuffled with the rows. The first documents
of a category are told by a cut: the key at which its limit is reached. A histogram over the keys' leading
hex digits (bucket) finds the bucket of the cut, and only the rows of that bucket are ranked. Rows
are then held against their category's cut where they are.

Step 4 is computed exactly without walking documents one by one. A category has a surplus S:
S more documents may leave it. In a pass, each undecided document is ranked by key among the
undecided ones of each of its categories. If its rank is below the surplus in all of them, it
leaves, whatever becomes of the others: even if all before it left, each of its categories
would have surplus for it. The surpluses are lowered by those that leave; a document of a
category without surplus stays. Documents that share no open category are thus decided
in the same pass, and each pass decides the smallest key of every group of documents that
are linked by open categories at least. The passes follow the depth of such conflicts, not the number
of documents or categories; once few rows are left, one task walks them.

Taking the leavers out of the ranking is exact. A later pass sees a category with S - D of surplus,
where D left. A document with rank S or more had all D before it. One with a smaller rank
has a rank below the new surplus again: behind it, below S, were at most S - 1 - rank leavers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.operators.corpus import Corpus, subset_docs
from corpuskit.session import drop_materialized, materialize

BUCKET_HEX_DIGITS = 3  # 4096 buckets
#: Undecided rows (a document in a category) that are few enough for one task.
TAIL_ROWS = 100_000


def split_key(doc_id: Column, seed: int = 0) -> Column:
    """Seeded order key."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), doc_id.cast("string")))


def _bucket(key: Column) -> Column:
    return F.conv(F.substring(key, 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")


def split_targets(corpus: Corpus, field: str, ratio: float = 0.3) -> DataFrame:
    """``(uri, count, target)`` per category of ``field`` (zero-support included)."""
    from corpuskit.operators.corpus import support

    s = support(corpus, field)
    return s.select("uri", F.col("support").alias("count"),
                    F.bround(F.col("support") * F.lit(float(ratio)), 0).cast("long").alias("target"))


def keyed_assignments(corpus: Corpus, field: str, seed: int = 0) -> DataFrame:
    a = corpus.assignments.where(F.col("field") == field).select("doc_id", "uri")
    key = split_key(F.col("doc_id"), seed)
    return a.withColumn("key", key).withColumn("bucket", _bucket(F.col("key")))


def _cuts(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``(__cu, last_in, first_out)`` per category with a ``limit`` above 0: the largest key among its first ``limit``
    rows, and a key above it that no later row is below.

    ``rows(doc_id, uri, key, bucket)``, ``limits(__lu, limit)``.
    """
    per_bucket = rows.where("bucket IS NOT NULL").groupBy("uri", "bucket").agg(F.count(F.lit(1)).alias("n"))
    wb = Window.partitionBy("uri").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.select("uri", "bucket", F.coalesce(F.sum("n").over(wb), F.lit(0)).alias("before"))
    edge = materialize(before.join(limits, before["uri"].eqNullSafe(limits["__lu"])).where("before < limit")
                       .groupBy("uri").agg(F.max(F.struct("bucket", "before", "limit")).alias("e"))
                       .select(F.col("uri").alias("__cu"), F.col("e.bucket").alias("__cb"), "e.before", "e.limit"), "split_edge")
    inside = rows.join(edge, rows["uri"].eqNullSafe(edge["__cu"]) & (rows["bucket"] == edge["__cb"]))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("__cu").orderBy("key")) - 1
    end = F.concat(F.lpad(F.lower(F.hex("__cb")), BUCKET_HEX_DIGITS, "0"), F.lit("g"))  # above every key of the bucket
    cuts = materialize(inside.select("__cu", "__cb", "key", (rank < F.col("limit")).alias("in")).groupBy("__cu", "__cb").agg(
        F.max(F.when(F.col("in"), F.col("key"))).alias("last_in"),
        F.min(F.when(~F.col("in"), F.col("key"))).alias("first_out")).select(
        "__cu", "last_in", F.coalesce("first_out", end).alias("first_out")), "split_cuts")
    drop_materialized(edge)
    return cuts


def _keyed(rows: DataFrame, seed: int) -> DataFrame:
    return rows.withColumn("key", split_key(F.col("doc_id"), seed)).withColumn("bucket", _bucket(F.col("key")))


def split_candidates(corpus: Corpus, field: str, ratio: float = 0.3, seed: int = 0) -> DataFrame:
    """``(doc_id)`` of the initial selection."""
    own, targets = _own(corpus, field, ratio)
    cuts = _cuts(_keyed(own, seed), targets.select("__tu", "target").toDF("__lu", "limit"))
    keyed = _keyed(own, seed)
    ids = materialize(keyed.join(cuts, keyed["uri"].eqNullSafe(cuts["__cu"])).where("key <= last_in")
                      .select("doc_id").distinct(), "split_candidates")
    drop_materialized(own, targets, cuts)
    return ids


def _own(corpus: Corpus, field: str, ratio: float) -> tuple[DataFrame, DataFrame]:
    """The assignments of the field and the targets of its categories, written once."""
    own = materialize(corpus.assignments.where(F.col("field") == field).select("doc_id", "uri"), "split_assigned")
    assigned = corpus.with_(assignments=own.select(F.lit(field).alias("field"), "doc_id", "uri"))
    targets = split_targets(assigned, field, ratio).select(F.col("uri").alias("__tu"), "target")
    return own, materialize(targets, "split_targets")


def split_pruned(corpus: Corpus, field: str, ratio: float = 0.3, seed: int = 0,
                 tail_rows: int = TAIL_ROWS) -> DataFrame:
    """I4: ``(doc_id)`` of the documents kept after greedy surplus removal.

    Passes run until at most ``tail_rows`` rows are undecided; these few are walked in one task.
    """
    own, targets = _own(corpus, field, ratio)
    cuts = _cuts(_keyed(own, seed), targets.select("__tu", "target").toDF("__lu", "limit"))
    rows = materialize(_selected(_keyed(own, seed), cuts), "split_selected")
    cand = rows.select("doc_id").distinct()
    counts = rows.groupBy("uri").agg(F.count(F.lit(1)).alias("selected"))
    surplus = materialize(counts.join(targets, counts["uri"].eqNullSafe(targets["__tu"])).select(
        F.col("uri").alias("__su"), (F.col("selected") - F.col("target")).alias("surplus")), "split_surplus")
    drop_materialized(own, cuts)
    still_open = rows.join(surplus, rows["uri"].eqNullSafe(surplus["__su"])).drop("__su").withColumn("seed", F.lit(seed))
    if not surplus.where("surplus <= 0").isEmpty():
        still_open = still_open.withColumn("least", F.min("surplus").over(Window.partitionBy("doc_id"))) \
            .where("least > 0").drop("least")
    passes, read = [], [rows, surplus, targets]
    while True:
        n = still_open.count()
        if n == 0:
            break
        judged = _pass(still_open) if n > tail_rows else _walk(still_open)
        passes.append(materialize(judged, "split_rows"))
        read.append(judged)  # with what the pass wrote on its way
        if n <= tail_rows:
            break
        still_open = passes[-1].where("NOT leaves").drop("leaves")
    if passes:
        cand = cand.join(reduce(DataFrame.unionByName, [p.where("leaves").select("doc_id") for p in passes]).distinct(),
                         "doc_id", "left_anti")
    kept = materialize(cand, "split_kept")
    drop_materialized(*read, *passes)
    return kept


def _selected(keyed: DataFrame, cuts: DataFrame) -> DataFrame:
    """``(doc_id, uri, width)``: all rows of the documents that one of their categories selects, with their number.

    A document above the largest cut is selected by none, so its rows are not shuffled.
    """
    most = cuts.agg(F.max("last_in")).first()[0]
    low = keyed.where(F.col("key") <= F.lit(most)) if most is not None else keyed.limit(0)
    own = Window.partitionBy("doc_id")
    return (low.join(cuts, low["uri"].eqNullSafe(cuts["__cu"]), "left")
            .select("doc_id", "uri", F.coalesce(F.col("key") <= F.col("last_in"), F.lit(False)).alias("in"))
            .select("doc_id", "uri", F.max("in").over(own).alias("chosen"), F.count(F.lit(1)).over(own).alias("width"))
            .where("chosen").drop("chosen"))


def _walk(rows: DataFrame) -> DataFrame:
    """The last undecided documents, one by one in the order of their keys (a bounded number of rows)."""
    def run(batches):
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        docs, uris = table.column("doc_id").to_pylist(), table.column("uri").to_pylist()
        surplus = dict(zip(uris, table.column("surplus").to_pylist()))
        leaves, at = [], 0
        while at < len(docs):
            stop = at
            while stop < len(docs) and docs[stop] == docs[at]:
                stop += 1
            leaving = all(surplus[u] > 0 for u in uris[at:stop])
            for u in uris[at:stop]:
                surplus[u] -= leaving
            leaves += [leaving] * (stop - at)
            at = stop
        yield from table.append_column("leaves", pa.array(leaves, pa.bool_())).to_batches()

    kept = rows.select("doc_id", "uri", "width", "surplus", "seed")
    key = F.md5(F.concat(F.col("seed").cast("string"), F.lit(":"), F.col("doc_id").cast("string")))
    ordered = kept.coalesce(1).sortWithinPartitions(key, "doc_id")
    return ordered.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", leaves boolean")


def _pass(rows: DataFrame) -> DataFrame:
    """The rows of undecided documents after a pass: those that leave, and those that are still open, with the
    surplus left. Documents that stay have no rows any more.

    At most a category's surplus of rows are before its cut; a document leaves if all its rows are. Only
    these rows are grouped by document to find the leavers.
    """
    key = F.md5(F.concat(F.col("seed").cast("string"), F.lit(":"), F.col("doc_id").cast("string")))
    keyed = rows.withColumn("key", key).withColumn("bucket", _bucket(F.col("key")))
    limits = materialize(rows.groupBy(F.col("uri").alias("__lu")).agg(F.max("surplus").alias("limit")), "split_limits")
    cuts = _cuts(keyed, limits)
    own = Window.partitionBy("doc_id")
    leaving = materialize(
        keyed.join(cuts, keyed["uri"].eqNullSafe(cuts["__cu"])).where("key < first_out").select("doc_id", "uri", "width")
        .withColumn("n", F.count(F.lit(1)).over(own)).where("n = width").select("doc_id", "uri"), "split_leaving")
    less = leaving.groupBy(F.col("uri").alias("__gu")).agg(F.count(F.lit(1)).alias("less"))
    new = materialize(limits.join(less, limits["__lu"].eqNullSafe(less["__gu"]), "left").select(
        F.col("__lu").alias("__nu"), (F.col("limit") - F.coalesce("less", F.lit(0))).alias("__new")), "split_surplus")
    drop_materialized(limits, cuts)
    gone = leaving.select("doc_id", F.lit(True).alias("__gone")).distinct()
    return (rows.join(new, rows["uri"].eqNullSafe(new["__nu"])).join(gone, "doc_id", "left")
            .select("doc_id", "uri", "width", F.col("__new").alias("surplus"), "seed", F.coalesce("__gone", F.lit(False)).alias("leaves"))
            .withColumn("least", F.min("surplus").over(own)).where("leaves OR least > 0").drop("least"))


def balanced_split(corpus: Corpus, field: str, ratio: float = 0.3, seed: int = 0) -> tuple[Corpus, Corpus]:
    """``(rest, kept)``; kept holds about ``ratio`` of every category."""
    kept_ids = split_pruned(corpus, field, ratio, seed)
    rest_ids = corpus.docs.select("doc_id").join(kept_ids, "doc_id", "left_anti")
    return subset_docs(corpus, rest_ids), subset_docs(corpus, kept_ids)
