"""Quality classifier by compression: which class's dictionary shortens a text more.

Two zstandard dictionaries are trained, one from good and one from bad labelled texts.
A text is cut into pieces of ``PIECE`` bytes, each compressed with either dictionary (the
pieces keep a long text from becoming its own context). The difference of the sizes over
the text's length, with the size itself (repetition) and the length (how sure the
difference is), is calibrated to a probability by a logistic curve that other labelled
rows fix.

Fitting reads a bounded sample: ``DICTIONARY_DOCS`` labelled texts of each class of at
most ``DICTIONARY_BYTES`` bytes for the dictionaries, and ``CALIBRATION_DOCS`` others of
each class for the curve, all by smallest hash. Scoring reads every text whole.

Defined results: null and empty texts score the calibration sample's share of good rows;
without labelled rows of both classes every text scores 1 (nothing is rejected); rows
that repeat score alike; a label row without a document, and a null label, teach nothing;
columns named like the added ones are replaced, others pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import hash52

PIECE = 1024
LEVEL = 3
DICTIONARY_SIZE = 112_640
DICTIONARY_DOCS = 1_500
DICTIONARY_BYTES = 16_384
CALIBRATION_DOCS = 6_000
THRESHOLD = 0.3
SIZES = "struct<n:long,good:long,bad:long>"


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    share: float  # of good rows

    @property
    def fitted(self) -> bool:
        return bool(self.weights)


def held_out(key: Column) -> Column:
    """The rows that are never learned from."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train_dictionary(texts: list[bytes]) -> bytes:
    """A dictionary from the texts' pieces; too few of them are used as they are."""
    import zstandard

    pieces = [t[i: i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_SIZE, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_SIZE:]


def compressed_sizes(good: bytes, bad: bytes):
    """An Arrow UDF: text -> its bytes, and its compressed sizes with either dictionary."""

    def sizes(column: pa.Array) -> pa.Array:
        import zstandard

        packers = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                    write_checksum=False, write_dict_id=False).compress)
        rows = []
        for text in column:
            t = (text.as_py() or "").encode("utf-8", "replace")
            pieces = [t[i: i + PIECE] for i in range(0, len(t), PIECE)]
            rows.append((len(t), *(sum(len(pack(p)) for p in pieces) for pack in packers)))
        n, g, b = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n, g, b)], names=["n", "good", "bad"])

    return F.arrow_udf(sizes, SIZES)


def _terms(n: Column, good: Column, bad: Column) -> list[Column]:
    """What the curve weighs, from the sizes of a text that isn't empty."""
    difference = (bad - good) / n
    size = F.ln((good + bad) / (F.lit(2.0) * n))
    length = F.ln(n.cast("double")) / F.lit(10.0)
    return [F.lit(1.0), difference, size, size * size, length, difference * length]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton's method for a logistic fit."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, part: int, each: int, key: str, text: str) -> DataFrame:
    """``(quality, text)`` of the ``each`` rows of either class with the smallest hash, from one of two halves."""
    rows = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key))).select(
        F.col(key).alias("__id"), F.col("quality").alias("__quality"), hash52(F.lit("fit"), F.col(key)).alias("__h"))
    rows = rows.where(F.pmod(F.col("__h").cast("long"), F.lit(2)) == part)
    few = None
    for label in (0, 1):
        one = rows.where(F.col("__quality") == label).orderBy("__h", "__id").limit(each)
        few = one if few is None else few.unionAll(one)
    return (docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
            .join(F.broadcast(few), F.col("__key") == F.col("__id"))  # at most 2 * each rows
            .where(F.length("__text") > 0).select("__quality", "__text"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> CompressionModel:
    """Learn from labelled rows that aren't held out. ``labels`` has the key and ``quality`` 0 or 1."""
    sample = _sample(docs, labels, 0, DICTIONARY_DOCS, key, text).where(
        F.octet_length("__text") <= DICTIONARY_BYTES).collect()
    texts = {q: sorted(r["__text"].encode() for r in sample if r["__quality"] == q) for q in (0, 1)}
    if not texts[0] or not texts[1]:
        return CompressionModel(b"", b"", (), 1.0)
    good, bad = train_dictionary(texts[1]), train_dictionary(texts[0])
    sized = _sample(docs, labels, 1, CALIBRATION_DOCS, key, text).select(
        "__quality", compressed_sizes(good, bad)("__text").alias("s"))
    rows = sized.select(F.array(*_terms(F.col("s.n"), F.col("s.good"), F.col("s.bad"))).alias("x"), "__quality").collect()
    y = np.array([r["__quality"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return CompressionModel(b"", b"", (), 1.0)
    x = np.array([r["x"] for r in rows], float)
    order = np.lexsort([*x.T, y])  # the sums don't depend on the order in which rows arrive
    # classes are sampled alike; weigh good rows back to their share among all labelled ones
    counts = dict(labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col(key))).groupBy("quality").count().collect())
    w = _logistic(x[order], y[order])
    w[0] += math.log(counts[1] / counts[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return CompressionModel(good, bad, tuple(w.tolist()), counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: CompressionModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 if score >= 0.3)."""
    if not model.fitted:
        return docs.withColumn("score", F.lit(1.0)).withColumn("predicted", F.lit(1))
    sized = docs.withColumn("__s", compressed_sizes(model.good, model.bad)(F.col(text)))
    n, good, bad = F.col("__s.n"), F.col("__s.good"), F.col("__s.bad")
    logit = sum((F.lit(w) * t for w, t in zip(model.weights, _terms(n, good, bad))), F.lit(0.0))
    value = F.when(n > 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).otherwise(F.lit(model.share))
    return (sized.withColumn("score", value).drop("__s")
            .withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)))
