"""Mixing sources to target weights by Poisson replication.

Each document is repeated N times, N drawn from a Poisson distribution whose mean is its
source's target repetition rate. The draw inverts the distribution at a uniform number
hashed from seed, document id and text, so it needs no state and any task may repeat it.
The copies are then shuffled globally by a hash of document and copy number.

Defined results: a null source is a source of its own; a source without a rate or with
rate 0 gives no rows; rows equal in id and text get equal draws, but are kept apart by
nothing else; a null text counts as empty; an empty table gives an empty result; extra
columns pass through, and a column named like one of the added ones is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import HASH_SPAN, hash52, unit, within, written

#: Beyond this mean a Poisson draw is a sum of independent smaller ones, so exp(-mean) never vanishes.
PIECE = 32.0
#: Rate tables up to this many sources are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 10_000
ADDED = ("rate", "n_copies", "copy", "shuffle_key")


def rates_by_power(docs: DataFrame, power: float = 0.5, epochs: float = 1.0,
                   source: str = "source", text: str = "text") -> DataFrame:
    """``(source, rate)`` of every source: weights follow size**power; the mix is ``epochs`` times the input's size.

    Sizes count characters, so a source whose texts are all null or empty has no weight and rate 0:
    none of its documents are drawn. Empty texts of other sources are drawn at their source's rate.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.length(F.coalesce(F.col(text), F.lit("")))).alias("size"))
    sizes = written(sizes, "sizes")  # a row per source, read several times
    total, spread = sizes.where("size > 0").agg(F.sum("size"), F.sum(F.pow(F.col("size").cast("double"), F.lit(power)))).first()
    share = F.pow(F.col("size").cast("double"), F.lit(power)) / F.lit(float(spread or 1.0))
    rate = F.when(F.col("size") > 0, F.lit(float(epochs) * (total or 0)) * share / F.col("size")).otherwise(F.lit(0.0))
    return sizes.select("source", rate.alias("rate"))


def _pieces(rate: Column) -> Column:
    return F.greatest(F.ceil(rate / F.lit(PIECE)).cast("int"), F.lit(1))


def cumulative(rate: Column) -> Column:
    """P(N <= 0), P(N <= 1), ... of one piece of ``rate``, up to where the tail is below a double's grain."""
    mean = rate / _pieces(rate)
    last = F.ceil(mean + F.lit(12.0) * F.sqrt(mean) + F.lit(24.0)).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("c"), F.array().cast("array<double>").alias("t"))
    return F.aggregate(F.sequence(F.lit(1), last), start, lambda a, k: F.struct(
        (a["p"] * mean / k).alias("p"), (a["c"] + a["p"] * mean / k).alias("c"),
        F.concat(a["t"], F.array(a["c"])).alias("t")))["t"]


def poisson_count(rate: Column, *key: Column, steps: Column | None = None) -> Column:
    """A Poisson draw with mean ``rate`` from the hash of ``key``; ``steps`` is ``cumulative(rate)`` where that is at hand.

    Each piece's uniform number is hashed once and held against the steps: the smallest n with u < P(N <= n).
    """
    steps = cumulative(rate) if steps is None else steps
    draws = F.transform(F.sequence(F.lit(1), _pieces(rate)), lambda i: unit(*key, i))
    return F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter(steps, lambda c: c <= u)))


def poisson_mix(docs: DataFrame, rates: DataFrame, seed: str = "mix", key: str = "doc_id",
                source: str = "source", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Every copy of every document with ``rate, n_copies, copy, shuffle_key``, in global random order.

    ``partitions`` ranges of the order become the result's partitions (default: the session's shuffle partitions).
    """
    small = rates.select(F.col("source").alias("__source"), F.col("rate").cast("double").alias("rate"))
    small = small.where("rate > 0").withColumn("__steps", cumulative(F.col("rate")))
    if within(small, BROADCAST_ROWS):
        small = F.broadcast(small)
    body = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.drop(*ADDED).join(small, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    drawn = rows.withColumn("__body", body).withColumn(
        "n_copies", poisson_count(F.col("rate"), F.lit(seed), F.col(key), F.col("__body"), steps=F.col("__steps")))
    # the outer form keeps the planner from drawing again in filters below the explode
    times = F.when(F.col("n_copies") > 0, F.sequence(F.lit(1), F.col("n_copies")))
    copies = drawn.drop("__steps").withColumn("copy", F.explode_outer(times)).where("copy IS NOT NULL")
    keyed = copies.withColumn("shuffle_key", hash52(F.lit(seed + "/order"), F.col(key), F.col("__body"),
                                                    F.col("copy")).cast("long"))
    # the keys are uniform, so their ranges are known and nothing is sampled
    parts = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.col("shuffle_key") / F.lit(HASH_SPAN) * F.lit(parts)).cast("int")
    return keyed.drop("__body").repartitionById(parts, place).sortWithinPartitions("shuffle_key", key, "copy")
