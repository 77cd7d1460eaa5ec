"""Quality rules with an isolation forest over rule statistics.

Each text gives a handful of counts (words, symbols, repeated lines and windows, upper
case, ...). A fixed base rule fails texts that are too short or repeat themselves. Over
the rest, an isolation forest learns what is usual: trees split random columns at random
places, and documents that few splits set apart have short paths and are anomalous. The
path length below which a document is dropped is read off labelled rows: as many bad
ones as possible, while at most ``MAX_GOOD_LOSS`` of the good ones fall below it.

Every tree sees ``SAMPLE`` rows, as the method wants it; they come from a pool of at most
``TREES * SAMPLE`` documents by smallest hash. Counts, scores and the histogram behind the
threshold cover all rows.

Defined results: a null or empty text has no words and fails the base rule; without
labels of both kinds nothing else is dropped; equal texts get equal verdicts; an empty
table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import HASH_SPAN, blobs, hash52, slices, written

TREES = 100
SAMPLE = 256
MAX_GOOD_LOSS = 0.002
BINS = 4096
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct", "n_upper", "n_letters", "n_marks")
FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "marks")
SYMBOLS = b"#*$%&|<>"
LETTERS_UP = bytes(range(65, 91))
LETTERS_LOW = bytes(range(97, 123))
OTHERS = {name: bytes(sorted(set(range(256)) - set(keep))) for name, keep in
          (("symbols", SYMBOLS), ("upper", LETTERS_UP), ("letters", LETTERS_UP + LETTERS_LOW),
           ("marks", b"!?"), ("space", b" \t\n\x0b\x0c\r"), ("follow", bytes(range(0x80, 0xC0))))}


def _count(text: bytes, kind: str) -> int:
    return len(text.translate(None, OTHERS[kind]))


def repeated(code: np.ndarray, size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more; ``code`` numbers the words of a text."""
    n = len(code) - size + 1
    if n < 2:
        return 0
    # a window that occurs twice starts with shorter ones that do: lengthen only those
    base = int(code.max()) + 1
    at = np.flatnonzero(np.bincount(code)[code[:n]] > 1)
    window = code[at]
    for k in range(1, size):
        if len(at) < 2:
            return 0
        _, window, times = np.unique(window * base + code[at + k], return_inverse=True, return_counts=True)
        again = times[window] > 1
        at, window = at[again], window[again].astype(np.int64)
    cover = np.zeros(len(code) + 1, np.int64)
    cover[at] = 1
    cover[size:] -= cover[:-size].copy()  # each start opens a window that ends ``size`` words on
    return int((np.cumsum(cover) > 0).sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of one text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    chars = len(text) - _count(text, "follow") - _count(text, "space")
    number: dict = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return (len(words), chars, _count(text, "symbols"), len(lines) - len(set(lines)),
            repeated(code) if len(number) < len(words) else 0, len(lines), len(number), _count(text, "upper"), _count(text, "letters"), _count(text, "marks"))


def count_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the ``COUNTS`` of every row, whole texts."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                rows = [statistics(t) for t in blobs(part, "__text")]
                cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["doc_id", *COUNTS])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


def features(rows) -> np.ndarray:
    """The ``FEATURES`` from columns of counts (anything indexable by name).

    Each is a rate beyond what any ordinary text may have, so that ordinary texts meet in
    one corner and only offences set documents apart.
    """
    c = {k: np.asarray(rows[k], float) for k in COUNTS}
    some = lambda k: np.maximum(c[k], 1)
    beyond = lambda x, most: np.maximum(x - most, 0)
    return np.column_stack([
        beyond(np.abs(c["word_chars"] / some("n_words") - 6.5), 4.0),
        c["n_symbols"] / some("word_chars"),
        beyond(c["n_dup_lines"] / some("n_lines"), 0.3),
        beyond(c["n_repeat_words"] / some("n_words"), 0.15),
        beyond(0.6, c["n_distinct"] / some("n_words") ** 0.85),  # distinct words grow slower than words
        beyond(c["n_upper"] / some("n_letters"), 0.25),
        beyond(c["n_marks"] / some("n_words"), 0.15)])


def _usual_path(n: int) -> float:
    """Mean path length of a search among ``n`` rows in a random tree."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass(frozen=True)
class Forest:
    column: np.ndarray  # (trees, nodes); -1 at a leaf
    split: np.ndarray
    length: np.ndarray  # at a leaf: its depth and the path usual for the rows it holds
    depth: int

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row: short means anomalous."""
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for column, split, length in zip(self.column, self.split, self.length):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                c = column[node]
                down = 2 * node + 1 + (x[row, np.maximum(c, 0)] >= split[node])
                node = np.where(c >= 0, down, node)
            total += length[node]
        return total / max(len(self.column), 1)


def grow(x: np.ndarray, seed: int = 7) -> Forest:
    """A forest of ``TREES`` trees, each over ``SAMPLE`` rows of ``x`` drawn without replacement."""
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(SAMPLE)))
    nodes = 2 ** (depth + 1) - 1
    column = np.full((TREES, nodes), -1, np.int64)
    split, length = np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    for t in range(TREES):
        todo = [(0, 0, rng.permutation(len(x))[:SAMPLE])]
        while todo:
            node, at, rows = todo.pop()
            low, high = (x[rows].min(0), x[rows].max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if at == depth or len(rows) <= 1 or not len(open_):
                length[t, node] = at + _usual_path(len(rows))
                continue
            c = rng.choice(open_)
            column[t, node], split[t, node] = c, rng.uniform(low[c], high[c])
            right = x[rows, c] >= split[t, node]
            todo += [(2 * node + 1, at + 1, rows[~right]), (2 * node + 2, at + 1, rows[right])]
    return Forest(column, split, length, depth)


def fit_forest(counted: DataFrame) -> Forest | None:
    """A forest over the documents that pass the base rule; None if there are none."""
    size, fit = TREES * SAMPLE, counted.where(~base_failed())
    share = 2.0 * size / max(fit.count(), 1)  # a hash below this share leaves enough, and tasks send few rows
    pool = (fit.withColumn("__h", hash52(F.lit("forest"), F.col("doc_id"), F.col("word_chars")))
            .where(F.col("__h") < F.lit(share * HASH_SPAN)).orderBy("__h", *COUNTS).limit(size).select(*COUNTS).toPandas())
    return grow(features(pool)) if len(pool) else None


def add_paths(counted: DataFrame, forest: Forest | None) -> DataFrame:
    """``counted`` with ``path``, the mean path length (null if there is no forest)."""
    if forest is None:
        return counted.withColumn("path", F.lit(None).cast("double"))
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in counted.schema.fields)}, path double"

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), 10_000):
                part = frame.iloc[at: at + 10_000]
                yield part.assign(path=forest.paths(features(part)))

    return counted.mapInPandas(run, schema)


def calibrate(scored: DataFrame, labels: DataFrame, max_good_loss: float = MAX_GOOD_LOSS) -> float:
    """The path length below which documents go, from a histogram over all labelled rows."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col("quality").alias("__q"))
    top = 2.0 * np.log2(SAMPLE) + 8
    bins = (scored.where(~base_failed() & F.col("path").isNotNull()).join(known, F.col("doc_id") == F.col("__id"))
            .groupBy(F.floor(F.col("path") / top * BINS).cast("int").alias("bin"), "__q").count().collect())
    good, bad = np.zeros(BINS + 1, np.int64), np.zeros(BINS + 1, np.int64)
    for r in bins:
        (good if r["__q"] == 1 else bad)[min(r["bin"], BINS)] += r["count"]
    if not good.sum() or not bad.sum():
        return 0.0
    lost = np.concatenate([[0], np.cumsum(good)])[: BINS + 1]
    caught = np.concatenate([[0], np.cumsum(bad)])[: BINS + 1]
    allowed = np.flatnonzero(lost <= max_good_loss * good.sum())
    best = allowed[caught[allowed] == caught[allowed].max()][0]  # the lowest that catches as many
    return float(best) / BINS * top


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the ``COUNTS``, ``base_failed``, ``path`` and ``kept`` of every row."""
    counted = written(count_documents(docs, key, text), "rule-counts")
    scored = written(add_paths(counted, fit_forest(counted)), "rule-paths")
    below = calibrate(scored, labels)
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("path") >= below, F.lit(True)))

