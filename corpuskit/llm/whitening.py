"""Whitening of integer vectors: leading principal components by contour integration (FEAST).

Spark sums the vectors, then the products of the centred vectors, each task sending one row per
dimension and block of dimensions. What comes to the driver is the covariance, ``d x d`` numbers for
vectors of ``d`` entries, whatever the number of vectors. There the leading eigenpairs are found:

* The inertia of ``V - s`` (the signs of the pivots of an LDL' factorisation, of ``V`` in tridiagonal form) counts
  the eigenvalues above ``s``. Bisection on it cuts the spectrum into intervals, with borders in gaps.
* For each interval, ``P Y = 1/(2 pi i)`` times the integral of ``(zI - V)^-1 Y`` around it is taken
  by Gauss-Legendre quadrature on the upper half circle. ``P`` projects onto the interval's
  eigenvectors. Rayleigh-Ritz in the projected space gives eigenpairs, which start the next turn.
* The turns end when the residuals are at rounding level; the interval must then hold as many Ritz
  values as the inertia counted, or the start space is widened.

Vectors that are null or hold null entries must be dropped before (``finite``, ``quantised``). Vectors of
several lengths are an error. Repeated rows and ids count as often as they occur. Directions without
variance (an eigenvalue below 1e-13 of the trace) give no component: one vector, equal vectors
or an empty table give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of the covariance in one row of a task's sums.
BLOCK = 64
QUADRATURE = 16
#: Eigenvalues below this share of the trace are no variance.
NOTHING = 1e-13


# --- vectors ------------------------------------------------------------------

def finite(vector: Column) -> Column:
    """Whether a vector is there, and all its entries are there and finite."""
    c = F.transform(vector, lambda x: x.cast("double"))
    return vector.isNotNull() & F.coalesce(F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)), F.lit(False))


def quantised(vector: Column, scale: int = 1024, shift: int = 100_000) -> Column:
    """Each entry ``c`` as the long ``floor(scale * c) + shift``; one beyond 2^52 is an error."""
    def entry(x: Column) -> Column:
        big = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < float(1 << 52), big.cast("long") + F.lit(shift)) \
            .otherwise(F.raise_error(F.lit("vector entry too large")).cast("long"))

    return F.transform(vector, entry)


def _matrix(batch, column: str):
    """A batch's vectors as a matrix of int64."""
    import numpy as np
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.unique(np.asarray(pc.list_value_length(col)))
    if len(sizes) > 1:
        raise ValueError(f"vectors of several lengths: {sizes.tolist()}")
    return np.asarray(col.flatten()).astype(np.int64).reshape(batch.num_rows, -1)


# --- sums over all vectors ----------------------------------------------------

def vector_sums(df: DataFrame, vector: str) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total, n = None, 0
        for batch in batches:
            x = _matrix(batch, vector)
            if not len(x):
                continue
            if total is not None and total.shape[0] != x.shape[1]:
                raise ValueError("vectors of several lengths")
            total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.int64()),
                                              pa.array([n] * len(total), pa.int64())], names=["dim", "s", "n"])

    rows = df.select(vector).mapInArrow(run, "dim int, s long, n long") \
        .groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    if len({r["n"] for r in rows}) > 1:
        raise ValueError("vectors of several lengths")
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def product_sums(df: DataFrame, dims: int, left, schema_of: list[str]) -> "numpy.ndarray":  # noqa: F821
    """``sum(y y')`` over all rows, where ``left(batch)`` gives the rows' centred ``y``."""
    import numpy as np

    blocks = -(-dims // BLOCK)
    names = [f"c{k}" for k in range(BLOCK)]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                y = left(batch)
                total = y.T @ y if total is None else total + y.T @ y
        if total is None:
            return
        wide = np.zeros((dims, blocks * BLOCK))
        wide[:, :dims] = total
        cells = wide.reshape(dims * blocks, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(dims), blocks), pa.int32()), pa.array(np.tile(np.arange(blocks), dims), pa.int32()),
             *[pa.array(np.ascontiguousarray(cells[:, k])) for k in range(BLOCK)]], names=["row", "block", *names])

    schema = "row int, block int, " + ", ".join(f"{c} double" for c in names)
    summed = df.select(*schema_of).mapInArrow(run, schema).groupBy("row", "block").agg(*[F.sum(c).alias(c) for c in names])
    out = np.zeros((dims, blocks * BLOCK))
    for r in summed.collect():  # a row per dimension and block
        out[r["row"], r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = [r[c] for c in names]
    return out[:, :dims]


# --- eigenpairs of the covariance --------------------------------------------

def tridiagonal(v):
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the eigenvalues of ``v`` (Householder)."""
    import numpy as np

    a = np.array(v, dtype=float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        x[0] += math.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x /= norm
        part = a[k + 1:, k + 1:]
        y = part @ x
        y -= (x @ y) * x
        part -= 2 * (np.outer(x, y) + np.outer(y, x))
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
    return np.diagonal(a).tolist(), (np.diagonal(a, -1) ** 2).tolist()


def eigenvalues_above(t, s: float) -> int:
    """How many eigenvalues of a tridiagonal ``t`` are greater than ``s``: the positive pivots of the LDL'
    factorisation of ``t - s``, whose signs are its inertia (Sylvester's law)."""
    diagonal, off = t
    above, pivot, least = 0, 1.0, 1e-300
    for i, x in enumerate(diagonal):
        pivot = x - s - (off[i - 1] / pivot if i else 0.0)
        if abs(pivot) < least:
            pivot = -least
        above += pivot > 0
    return above


def _border(t, low: float, high: float, wanted: int) -> tuple[float, int]:
    """A point in ``[low, high]`` with at least ``wanted`` eigenvalues above it, few more, in a gap; and their number."""
    count = eigenvalues_above
    if count(t, low) <= wanted:
        return low, count(t, low)
    a, b = low, high  # count(a) >= wanted > count(b)
    for _ in range(100):
        mid = (a + b) / 2
        if not a < mid < b:
            break
        a, b = (mid, b) if count(t, mid) >= wanted else (a, mid)
    inside = count(t, a)  # a lies at the last wanted eigenvalue, and with it those that equal it
    down, below = a, low
    for _ in range(60):  # the next eigenvalue below
        mid = (down + below) / 2
        down, below = (mid, below) if count(t, mid) == inside else (down, mid)
    if a - below > 1e-6 * abs(a):
        return (a + below) / 2, inside
    return (low, count(t, low)) if inside + 1 > len(t[0]) else _border(t, low, below, inside + 1)


def _contour(v, low: float, high: float, inside: int):
    """The ``inside`` eigenpairs of ``v`` (of trace 1) in ``(low, high)``, by FEAST."""
    import numpy as np

    d = len(v)
    points, weights = np.polynomial.legendre.leggauss(QUADRATURE)
    angle = np.pi / 2 * (points + 1)
    middle, radius = (low + high) / 2, (high - low) / 2
    shifts = middle + radius * np.exp(1j * angle)
    solve = [np.linalg.inv(z * np.eye(d) - v) for z in shifts]
    size = min(d, 2 * inside + 8)
    while True:
        y = np.random.default_rng(0).standard_normal((d, size))
        best = None
        for _ in range(60):
            projected = sum(w / 2 * np.real(radius * np.exp(1j * t) * (s @ y)) for w, t, s in zip(weights, angle, solve))
            q, _ = np.linalg.qr(projected)
            value, inner = np.linalg.eigh(q.T @ v @ q)
            y = q @ inner
            here = (value > low) & (value < high)
            residual = np.abs(v @ y[:, here] - y[:, here] * value[here]).max() if here.any() else np.inf
            if here.sum() == inside and (best is None or residual < best[0] / 2):
                best = (residual, value[here], y[:, here])
            elif best is not None:
                break  # at rounding level: no turn makes it better
        if best is not None and best[0] <= 1e-13:  # of a matrix of trace 1
            return best[1], best[2]
        if size == d:
            raise ArithmeticError(f"{inside} eigenvalues counted between {low} and {high}, but not found")
        size = min(d, 2 * size)


def leading_components(v, k: int):
    """The ``k`` largest eigenvalues of the covariance ``v``, falling, and their unit eigenvectors as columns."""
    import numpy as np

    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    v = (v + v.T) / 2 / trace
    k, t = min(k, len(v)), tridiagonal(v)
    values, vectors = [], []
    high, found = 1.0 + 1e-6, 0
    while found < k and high > NOTHING:
        top, low = high, NOTHING / 2
        for _ in range(60):  # the largest eigenvalue below: the upper border comes close to it
            mid = (top + low) / 2
            top, low = (mid, low) if eigenvalues_above(t, mid) == found else (top, mid)
        if top <= NOTHING:
            break
        upper = min(high, top * 1.05)
        # an interval spans a factor of four at most, so that the filter tells its border's two sides apart
        border, counted = _border(t, max(NOTHING / 2, top / 4), top, k)
        if counted == found:
            break
        value, vector = _contour(v, border, upper, counted - found)
        values.append(value), vectors.append(vector)
        found, high = counted, border
    if not values:
        return np.zeros(0), np.zeros((len(v), 0))
    # one Rayleigh-Ritz over all intervals' vectors, which makes them orthogonal to rounding
    q, _ = np.linalg.qr(np.concatenate(vectors, axis=1))
    value, inner = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-value)
    keep = order[value[order] > NOTHING][:k]
    return value[keep] * trace, (q @ inner)[:, keep]


# --- the operator -------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with sums ``sums``; ``values`` and ``axes`` are the components, ``trace`` the whole variance."""

    n: int
    sums: tuple[int, ...]
    values: "numpy.ndarray"  # noqa: F821
    axes: "numpy.ndarray"  # noqa: F821
    trace: float

    def mean(self):
        import numpy as np

        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def centred(self, x):
        """``x - S/n``: the whole part is taken off exactly."""
        import numpy as np

        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whitened(self, x):
        import numpy as np

        return self.centred(x) @ self.axes / np.sqrt(self.values)

    def deviation(self, x) -> list[int]:
        """Per row, the exact sum of ``(n x - S)^2``; beyond 64 bits it is an error."""
        import numpy as np

        bound = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        exact = np.int64 if bound < 1 << 62 else object
        y = x.astype(exact) * self.n - np.array(self.sums, dtype=exact)
        if int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] >= 1 << 63:
            y = y.astype(object)
        out = (y * y).sum(axis=1).tolist()
        if max(out, default=0) >= 1 << 63:
            raise OverflowError("deviation beyond 64 bits")
        return out


def fit(df: DataFrame, vector: str, components: int = 8) -> Whitening | None:
    """The whitening of all vectors of ``df`` (integers); None without any vector."""
    import numpy as np

    n, sums = vector_sums(df, vector)
    if not n:
        return None
    empty = Whitening(n, tuple(sums), np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    if not sums:
        return empty
    v = product_sums(df, len(sums), lambda batch: empty.centred(_matrix(batch, vector)), [vector]) / n
    values, axes = leading_components(v, components)
    return Whitening(n, tuple(sums), values, axes, float(np.trace(v)))


def identity_error(df: DataFrame, vector: str, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, over all vectors."""
    import numpy as np

    k = len(model.values)

    def with_one(batch):
        w = model.whitened(_matrix(batch, vector))
        return np.concatenate((w, np.ones((len(w), 1))), axis=1)

    sums = product_sums(df, k + 1, with_one, [vector]) / model.n
    mean = sums[:k, k]  # zero but for rounding
    return float(np.abs(sums[:k, :k] - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(df: DataFrame, key: str, vector: str, model: Whitening, error: float) -> DataFrame:
    """A row per vector and component: ``(key, component, n, deviation, whitened, explained, identity_error)``."""
    kind = df.schema[key].dataType.simpleString()
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = len(model.values)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = batch.num_rows
            if not rows or not k:
                continue
            x = _matrix(batch, vector)
            ids = batch.column(batch.schema.get_field_index(key))
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                pa.array(np.full(rows * k, model.n), pa.int64()),
                pa.array(np.repeat(np.array(model.deviation(x), dtype=np.int64), k)), pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.values / model.trace, rows)), pa.array(np.full(rows * k, error))], names=names)

    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return df.select(key, vector).mapInArrow(run, schema)


def whitened_embeddings(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """Finite vectors in whole numbers, whitened on their leading components."""
    import numpy as np

    whole = embeddings.where(finite(F.col(vector))).select(F.col(key).alias(key), quantised(F.col(vector)).alias(vector))
    model = fit(whole, vector, components)
    if model is None:
        model = Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    error = identity_error(whole, vector, model) if len(model.values) else 0.0
    return whiten(whole, key, vector, model, error)
