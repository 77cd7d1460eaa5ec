"""Embedding near-dedup by cross-polytope hashing after fast Hadamard rotations.

A unit vector is turned at random (signs flipped and a fast Hadamard transform, three
times) and hashed to the nearest of the axes' ends, plus or minus. ``FUNCTIONS`` such
hashes name its bucket in a table; ``TABLES`` tables are kept, and each vector also looks
into the bucket it came closest to missing (multiprobe). Pairs that meet are verified by
their cosine in double precision.

Buckets are cut into tiles of a bounded number of vectors, and tiles are held against
each other, so a bucket of many alike vectors is shared out among tasks; a tile reports a
link count and one representative per vector, never the pairs. A pair that meets in more
than one table counts in the first. Equal vectors are one node with a count.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers
link with nothing and are their own component; vectors of different lengths don't link;
rows that repeat an id and a vector are vectors of their own; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import drop_written, written
from corpuskit.llm.components import components

THRESHOLD = 0.95
TABLES, FUNCTIONS = 14, 2
TILE = 1024
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised fast Hadamard transform of each row (their length is a power of two)."""
    n, step = x.shape[1], 1
    x = x.copy()
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def buckets(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, TABLES) bucket numbers of unit vectors of one length, and of the nearest other bucket."""
    dim = x.shape[1]
    wide = 1 << max(0, dim - 1).bit_length()
    padded = np.zeros((len(x), wide))
    padded[:, :dim] = x
    rng = np.random.default_rng(SEED + dim)
    main = np.zeros((len(x), TABLES), np.int64)
    probe = np.zeros((len(x), TABLES), np.int64)
    row = np.arange(len(x))
    for t in range(TABLES):
        first, second, gap = [], [], []
        for _ in range(FUNCTIONS):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], wide))
            size = np.abs(y)
            best = size.argmax(1)
            at = size[row, best]
            size[row, best] = -1
            next_ = size.argmax(1)
            first.append(2 * best + (y[row, best] < 0))
            second.append(2 * next_ + (y[row, next_] < 0))
            gap.append(at - np.maximum(size[row, next_], 0))
        change = np.argmin(gap, axis=0)  # the hash that came closest to another value
        for k in range(FUNCTIONS):
            main[:, t] = main[:, t] * 2 * wide + first[k]
            probe[:, t] = probe[:, t] * 2 * wide + np.where(change == k, second[k], first[k])
    return main, probe


def usable(vector: Column) -> Column:
    """Whether a vector can link: all numbers there and finite, and not all zero."""
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda v: v != 0), F.lit(False))


def hashed(nodes: DataFrame) -> DataFrame:
    """``nodes(node, n, vector)`` with ``unit`` (doubles as bytes), ``main`` and ``probe`` buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                vectors = [np.array(v, float) for v in part.column(2).to_pylist()]
                units = [v / np.abs(v).max() for v in vectors]  # no overflow when squared
                units = [v / np.sqrt(v @ v) for v in units]
                main, probe = [None] * len(units), [None] * len(units)
                for size in {len(v) for v in units}:
                    which = [i for i, v in enumerate(units) if len(v) == size]
                    for i, a, b in zip(which, *buckets(np.array([units[i] for i in which]))):
                        main[i], probe[i] = a, b
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([u.tobytes() for u in units], pa.binary()),
                     pa.array(main, pa.list_(pa.int64())), pa.array(probe, pa.list_(pa.int64()))],
                    names=["node", "n", "unit", "main", "probe"])

    return nodes.select("node", "n", "vector").mapInArrow(
        run, "node binary, n long, unit binary, main array<long>, probe array<long>")


class _Side:
    """The vectors of one half of a tile."""

    def __init__(self, rows: list[tuple]):
        self.node = [r[0] for r in rows]
        self.n = np.array([r[1] for r in rows], np.int64)
        self.unit = np.array([np.frombuffer(r[2]) for r in rows])
        self.main = np.array([r[3] for r in rows], np.int64)
        self.probe = np.array([r[4] for r in rows], np.int64)


def tile_links(a: _Side, b: _Side, table: int, threshold: float) -> np.ndarray:
    """Which of ``a`` links with which of ``b``, where they meet in this table for the first time."""
    near = a.unit @ b.unit.T >= threshold
    for t in range(table):
        if not near.any():
            break
        met = a.main[:, t, None] == b.main[None, :, t]
        met |= a.probe[:, t, None] == b.main[None, :, t]
        met |= a.main[:, t, None] == b.probe[None, :, t]
        near &= ~met
    return near


def tile_roots(near: np.ndarray) -> np.ndarray:
    """The smallest number reachable by links among the rows of a symmetric matrix."""
    root = np.arange(len(near))
    while True:
        seen = np.where(near, root[None, :], len(near)).min(axis=1, initial=len(near))
        new = np.minimum(root, seen)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _tile(rows: list[tuple], table: int, low: int, high: int, bucket: int, threshold: float) -> list[tuple]:
    """``(node, links, to)`` of one tile: rows are (node, n, unit, main, probe, home, chunk)."""
    out = []
    home, guest = [r for r in rows if r[5]], [r for r in rows if not r[5]]
    sizes = {len(r[2]) for r in rows}
    if len(sizes) > 1:  # lengths that share a bucket number
        return [x for s in sizes for x in _tile([r for r in rows if len(r[2]) == s], table, low, high, bucket, threshold)]
    mains = [[r for r in home if r[6] == c] for c in ({low, high} if low != high else {low})]
    if low == high:
        groups = [(mains[0], None)]
    else:
        groups = [(mains[0], mains[1])] if all(mains) else []
    # those that only look in meet those who live here, from either half
    for g in ({low, high}):
        other = high if g == low else low
        looking = [r for r in guest if r[6] == g]
        living = [r for r in home if r[6] == other]
        if looking and living:
            groups.append((looking, living))
    for one, two in groups:
        if not one:
            continue
        a = _Side(one)
        b = a if two is None else _Side(two)
        near = tile_links(a, b, table, threshold)
        if two is None:
            np.fill_diagonal(near, False)
        elif not one[0][5]:
            # looking in both ways is one meeting: the smaller node's look counts
            both = (a.main[:, table, None] == b.probe[None, :, table]) & (a.probe[:, table, None] == b.main[None, :, table])
            smaller = np.array([[x < y for y in b.node] for x in a.node]) if both.any() else both
            near &= ~(both & ~smaller)
        if not near.any():
            continue
        if two is None:
            root = tile_roots(near)
            links = near @ a.n
            out += [(a.node[i], int(links[i]), a.node[root[i]]) for i in np.flatnonzero(near.any(axis=1))]
        else:
            k = len(one)
            full = np.zeros((k + len(two),) * 2, bool)
            full[:k, k:], full[k:, :k] = near, near.T
            root, n, node = tile_roots(full), np.concatenate([a.n, b.n]), a.node + b.node
            links = full @ n
            out += [(node[i], int(links[i]), node[root[i]]) for i in np.flatnonzero(full.any(axis=1))]
    return out


def tiles(entries: DataFrame, threshold: float) -> DataFrame:
    """``(node, links, to)`` from ``entries(table, bucket, low, high, node, n, unit, main, probe, home, chunk)``."""
    names = ["table", "bucket", "low", "high"]
    rest = ["node", "n", "unit", "main", "probe", "home", "chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []

        def done(limit: int) -> Iterator[pa.RecordBatch]:
            nonlocal out
            if rows:
                out += _tile(rows, group[0], group[2], group[3], group[1], threshold)
            if len(out) >= limit:
                cols = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                                                  pa.array(cols[2], pa.binary())], names=["node", "links", "to"])
                out = []

        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            cols = list(zip(*[batch.column(i).to_pylist() for i in range(4, 11)]))
            for key, row in zip(keys, cols):
                if key != group:
                    yield from done(20_000)
                    group, rows = key, []
                rows.append(row)
        yield from done(1)

    dealt = entries.select(*names, *rest).repartition(*names).sortWithinPartitions(*names)
    return dealt.mapInArrow(run, "node binary, links long, to binary")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("node", F.when(usable(F.col("vector")), F.unhex(F.md5(F.to_json(F.struct("vector")).cast("binary")))))
    rows = written(rows, "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.first("vector").alias("vector"))
    coded = written(hashed(nodes), "hashed")
    where = coded.select("node", F.posexplode("main").alias("table", "bucket")).withColumn("home", F.lit(True))
    looks = (coded.select("node", F.posexplode("probe").alias("table", "bucket")).withColumn("home", F.lit(False)))
    places = where.unionByName(looks)
    full = (places.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("m"), F.max("home").alias("lived"))
            .where("m > 1 and lived").withColumn("chunks", F.ceil(F.col("m") / F.lit(TILE)).cast("int")))
    busy = (places.join(full.select("table", "bucket", "chunks"), ["table", "bucket"])
            .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("table", "bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                    "chunk", "home", "node"))
    found = written(tiles(busy.join(coded, "node"), threshold), "tile-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")).distinct())
    named = nodes.select("node", "n", "id").join(parts, "node", "left").join(links, "node", "left").select(
        "node", "n", "id", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    heads = named.groupBy("root").agg(F.min("id").alias("component_id"))
    told = written(named.join(heads, "root").select("node", "component_id", (F.col("links") + F.col("n") - 1).alias("n_links")),
                   "told")
    drop_written(coded, found)
    done = rows.select("id", "node").join(told, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return done.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))
