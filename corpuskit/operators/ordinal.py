"""Global positions without a single-partition window.

``with_ordinal`` sorts globally (range partitioning), writes the sorted rows once with
the id of their partition and their place in it, and takes both the rows and the counts
per partition from that table. A partition id is thus never evaluated twice: two plans
over one sort may be cut into different partitions. The offset table has one row per
partition, so broadcasting it is bounded by the partition count, not the data.
The order must be total (end it with a unique key) for positions to be reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.session import materialize


def with_ordinal(df: DataFrame, order: list[Column | str], name: str = "ord",
                 start: int = 0) -> DataFrame:
    """``df`` with the global position of each row in ``order``, from ``start``."""
    tagged = materialize(
        df.orderBy(*order).withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()), "ordinal")
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + local + F.lit(start))
            .drop("__pid", "__mid", "__off"))


def with_group_ordinal(df: DataFrame, group: str, order: list[Column | str], name: str = "ord") -> DataFrame:
    """``df`` with the position of each row within its ``group``, from 0.

    The rows are sorted once over all groups; a group's positions are global ones minus its
    first. The table of first positions has a row per group.
    """
    ranked = with_ordinal(df, [group, *order], "__at")
    first = ranked.groupBy(F.col(group).alias("__group")).agg(F.min("__at").alias("__first"))
    return (ranked.join(first, ranked[group].eqNullSafe(first["__group"]))
            .withColumn(name, F.col("__at") - F.col("__first")).drop("__at", "__first", "__group"))


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column | str], k: int,
                    salt_key: str, rank_name: str = "rank", bound: Column | None = None) -> DataFrame:
    """Rows with rank <= k per group, skew-safe; ``bound`` may lower k group by group.

    Phase 1 ranks inside ``(group, salt)`` and phase 2 the survivors, ``k`` of each salt at most. Both
    filter by the literal ``k``, so the planner cuts groups before the shuffle. There are as many salts as
    shuffle partitions: a group that holds all rows is ranked by all tasks, and nothing is counted first.
    """
    salts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(F.col(salt_key)), F.lit(salts))
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    w2 = Window.partitionBy(*group).orderBy(*order)
    stage1 = (df.withColumn("__salt", salt).withColumn("__r1", F.row_number().over(w1))
              .where(F.col("__r1") <= F.lit(k)))
    out = stage1.drop("__salt", "__r1").withColumn(rank_name, F.row_number().over(w2)) \
        .where(F.col(rank_name) <= F.lit(k))
    return out if bound is None else out.where(F.col(rank_name) <= bound)
