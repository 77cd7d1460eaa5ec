"""MinHash near-dedup: BagMinHash signatures of weighted word shingles, banded and verified.

A text is the multiset of its five-word shingles. Each shingle carries Poisson processes
over its weight axis, cut at 0, 1, 2, 4, 8, ...: one process per stretch, seeded by shingle
and stretch alone, whose points have a time, a place on the axis and a signature slot. A
text with weight w sees the points placed below w; a slot holds the earliest time. Two
texts then agree in a slot with a probability of their weighted Jaccard similarity, and
time runs only until all slots are filled.

Signatures are cut into ``BANDS`` bands of ``ROWS`` slots (a pair at 0.8 shares no band
with probability 1e-7). Texts that share a band are compared by a byte of each slot; a
share of agreeing slots below ``SURE`` is more than five standard deviations from 0.8. The
rest are verified on their multisets: links are pairs with overlap / union >= 0.8, and
classes are the links' components. Texts with the same words are one node from the start.

Bands come in turns: the first ones join most copies, and a later bucket is opened only where its
members are still in different classes. The members of a bucket meet in tiles of bounded size inside
tasks, and no pair becomes a row. In a tile one member after the other is held against all
that are not yet in its class, those of the smallest class first; it is done then. A tile ends when all that
are not done are in one class, so that many alike texts cost few comparisons, and every
pair that is not joined otherwise is made. A bucket too large for a tile is cut into chunks; when these
have been joined within, its members outside its largest class are held against all its chunks.

Defined results: fewer than five words make one shingle of them all; texts without words
(null, empty, white space) are copies of each other; a class's id is its smallest id, and
one row with that id is ``kept`` (of rows with equal id and words, which are repeats, one);
if all ids of a class are null, so is the class id, and one row is kept. An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import blobs, drop_written, give_back, slices, written
from corpuskit.llm.components import relabel

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
SLOTS = BANDS * ROWS
#: Bands taken together: the first ones join most copies, and the rest has little left to compare.
TURNS = ((0, 2), (2, 10), (10, BANDS))
SURE = 0.65
#: Bytes of multisets and sketches, and members, that make up a tile at most, about.
TILE_BYTES, TILE_ROWS = 8 << 20, 4000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def shingles(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """For each text a 128-bit digest of its words; then text numbers and hashes of all shingles."""
    import xxhash

    number: dict[bytes, int] = {}
    codes, sizes, nodes = [], [], []
    for t in texts:
        words = t.split()
        nodes.append(xxhash.xxh3_128_digest(b" ".join(words)))
        codes.extend([number.setdefault(w, len(number)) for w in words])
        sizes.append(len(words))
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
    word = hashed[np.array(codes, np.int64)] if codes else np.zeros(0, np.uint64)
    size = np.array(sizes, np.int64)
    start = np.cumsum(size) - size
    count = np.where(size >= SHINGLE, size - SHINGLE + 1, np.minimum(size, 1))
    doc = np.repeat(np.arange(len(texts)), count)
    at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(len(doc))
    with np.errstate(over="ignore"):
        h = np.zeros(len(doc), np.uint64)
        for k in range(SHINGLE):
            there = at + k < start[doc] + size[doc]
            h = mix(h * GOLDEN + np.where(there, word[np.minimum(at + k, max(len(word) - 1, 0))], np.uint64(k + 1))) if len(doc) else h
    return nodes, doc, h


def weighted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with counts, and for every shingle the number of its occurrence (from 0)."""
    with np.errstate(over="ignore"):
        order = np.argsort(mix(h + doc.astype(np.uint64) * GOLDEN), kind="stable")
    d, s = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(d)))
    nth = np.empty(len(d), np.int64)
    nth[order] = np.arange(len(d)) - np.repeat(first, count)
    return d[first], s[first], count, nth


def signatures(texts: int, doc: np.ndarray, h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(texts, SLOTS) earliest times; the rows of texts without shingles are infinite."""
    out = np.full((texts, SLOTS), np.inf)
    total = np.bincount(doc, weights=weight, minlength=texts)
    horizon = (np.log(SLOTS) + 4.0) / np.maximum(total, 1)
    todo = np.ones(texts, bool)
    while True:
        pick = todo[doc]
        _points(out, doc[pick], h[pick], weight[pick], horizon)
        todo = np.isinf(out).any(axis=1) & (total > 0)
        if not todo.any():
            return out
        horizon[todo] *= 2


def _points(out: np.ndarray, doc: np.ndarray, h: np.ndarray, weight: np.ndarray, horizon: np.ndarray) -> None:
    """Enter the points up to each text's horizon."""
    flat = out.reshape(-1)
    low, high, stretch = 0, 1, 0
    with np.errstate(over="ignore"):
        while len(doc):
            own = weight > low
            doc, h, weight = doc[own], h[own], weight[own]
            d, w = doc, weight
            state = mix(h + np.uint64(stretch + 1) * GOLDEN)
            time = np.zeros(len(d))
            while len(d):
                state = state + GOLDEN
                a = mix(state)
                time = time - np.log(uniform(a)) / (SLOTS * (high - low))
                on = time <= horizon[d]
                d, w, state, time, a = d[on], w[on], state[on], time[on], a[on]
                b = mix(a ^ GOLDEN)
                slot = ((b >> np.uint64(32)) * np.uint64(SLOTS) >> np.uint64(32)).astype(np.int64)
                seen = slice(None)
                if high - low > 1:  # a stretch that the weight may end in
                    place = low + ((b & np.uint64(0xFFFFFFFF)) * np.uint64(high - low) >> np.uint64(32)).astype(np.int64)
                    seen = place < w
                np.minimum.at(flat, d[seen] * SLOTS + slot[seen], time[seen])
            low, high, stretch = high, high * 2, stretch + 1


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """(texts, BANDS) 64-bit buckets."""
    bits = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN), (len(sig), BANDS))
        for k in range(ROWS):
            out = mix(out * GOLDEN + bits[:, :, k])
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, node, bands, sketch)``: the words' digest, the buckets of every row (none without words), slots' bytes."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                nodes, doc, h = shingles(blobs(part, "__text"))
                d, s, count, _ = weighted(doc, h)
                sig = signatures(len(nodes), d, s, count)
                bands = band_hashes(sig).view(np.int64)
                sketch = mix(sig.view(np.uint64)).astype(np.uint8)
                some = np.bincount(doc, minlength=len(nodes)) > 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(nodes, pa.binary()),
                     pa.array([b if z else [] for b, z in zip(bands, some)], pa.list_(pa.int64())),
                     pa.array([x.tobytes() for x in sketch], pa.binary())], names=["id", "node", "bands", "sketch"])
        give_back()

    return docs.select(F.col(key).alias("id"), F.col(text).alias("__text")).mapInArrow(
        run, f"id {kind}, node binary, bands array<long>, sketch binary")


def multisets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``(node, sketch, items)`` for ``wanted(id, node, sketch)``: sorted 64-bit items, one per occurrence of a shingle."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                _, doc, h = shingles(blobs(part, "__text"))
                *_, nth = weighted(doc, h)
                with np.errstate(over="ignore"):
                    item = mix(h + nth.astype(np.uint64) * GOLDEN)
                cut = np.searchsorted(doc, np.arange(1, part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([np.sort(x).tobytes() for x in np.split(item, cut)], pa.binary())],
                    names=["node", "sketch", "items"])
        give_back()

    # ids may repeat or be null: the words' digest is part of the join's key, so only texts of these words meet
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), words_digest(F.col(text)).alias("__node"))
    found = rows.join(wanted, F.col("__key").eqNullSafe(F.col("id")) & (F.col("__node") == F.col("node")))
    return found.select("node", "sketch", "__text").mapInArrow(
        run, "node binary, sketch binary, items binary").dropDuplicates(["node"])


def jaccard(x: bytes, y: bytes) -> float:
    """Overlap by union of two multisets of items."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.concatenate([x, y])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return same / max(len(both) - same, 1)


def agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The similarity that the slots' bytes show (unequal slots agree in one of 256 cases)."""
    return ((many == one).mean(axis=1) - 1 / 256) / (1 - 1 / 256)


def tile_links(labels: list[bytes], sketches: np.ndarray, items: list, threshold: float,
               asking: np.ndarray | None = None) -> list[tuple[bytes, bytes]]:
    """Labels of a tile's members that belong together, as (label, smallest label of its class).

    Members of different labels are held against each other; with ``asking``, only the pairs that have one of
    these members.
    """
    known = sorted(set(labels))
    code = {x: i for i, x in enumerate(known)}
    own = np.array([code[x] for x in labels])
    of = np.arange(len(known))  # the class of each label
    done = np.zeros(len(labels), bool)
    while True:
        left = of[own[~done]]
        sizes = np.bincount(left, minlength=len(known))
        may = ~done if asking is None else ~done & asking
        if not may.any() or (sizes > 0).sum() < 2:
            break
        candidates = np.flatnonzero(may)
        i = candidates[sizes[of[own[candidates]]].argmin()]
        done[i] = True
        rest = np.flatnonzero((of[own] != of[own[i]]) & ~done)
        alike = agreement(sketches[i], sketches[rest])
        for j in rest[np.argsort(-alike, kind="stable")][: int((alike >= SURE).sum())]:
            a, b = of[own[i]], of[own[j]]
            if a != b and jaccard(items[i], items[j]) >= threshold:
                of[of == max(a, b)] = min(a, b)
    return [(known[i], known[c]) for i, c in enumerate(of) if c != i]


def tiled(entries: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)`` labels that belong together, from ``entries(bucket, chunk, part, asks, label, sketch, items)``:
    the rows of equal bucket, chunk and part are a tile."""
    names = ["bucket", "chunk", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        of = None

        def tile() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
            asks = np.array(rows.column("asks").to_pylist(), bool)
            links = tile_links(rows.column("label").to_pylist(), sketches, rows.column("items").to_pylist(), threshold,
                               asks if of[2] >= 0 else None)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(3)])
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                key = tuple(keys[:, a].tolist())
                if held and key != of:
                    yield tile()
                    held = []
                of = key
                held.append(batch.slice(a, b - a))
        if held:
            yield tile()
        held.clear()
        give_back()

    dealt = entries.select(*names, "asks", "label", "sketch", "items").repartition(*names).sortWithinPartitions(*names)
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def link_classes(nodes: DataFrame, docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame | None:
    """``(node, label)`` for the nodes that share a bucket with others; None if there are none."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    everyone = written(rows.join(full, "bucket").select("band", "bucket", "node"), "members")
    busy = written(everyone.select("node").distinct().join(nodes.select("node", "id", "sketch"), "node"), "busy")
    if busy.isEmpty():
        return None
    sets = written(multisets(docs, busy, key, text), "multisets")
    sizes = sets.select("node", (F.length("items") + SLOTS).alias("size"))
    labels = written(busy.select("node", F.col("node").alias("label")), "labels")
    for low, high in TURNS:
        for ask in (False, True):
            now = everyone.where((F.col("band") >= low) & (F.col("band") < high)).join(labels, "node").join(sizes, "node")
            chunks = F.ceil(F.greatest(F.sum("size") / TILE_BYTES, F.count(F.lit(1)) / F.lit(TILE_ROWS))).cast("int")
            open_ = now.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), chunks.alias("chunks")).where("x <> y")
            if ask:
                open_ = open_.where("chunks > 1")
            placed = written(now.join(open_.select("bucket", "chunks"), "bucket").select(
                "bucket", "node", "label", "size", "chunks", F.pmod(F.xxhash64("node", "bucket"), F.col("chunks")).cast("int").alias("chunk")),
                "placed")
            if placed.isEmpty():
                drop_written(placed)
                continue
            entries = _against_all(placed) if ask else placed.select(
                "bucket", "chunk", F.lit(-1).alias("part"), F.lit(False).alias("asks"), "node", "label")
            links = written(tiled(entries.join(sets, "node"), threshold), "links")
            fresh = relabel(labels, links)
            drop_written(links, placed)
            if fresh is not labels:
                drop_written(labels)
                labels = fresh
    drop_written(sets, busy, everyone)
    return labels


def _against_all(placed: DataFrame) -> DataFrame:
    """Tiles of large buckets: the members outside the bucket's largest class, in parts, with each of its chunks."""
    by_label = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = by_label.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
    marked = placed.join(largest, "bucket")
    others = marked.where("label <> largest")
    parts = others.groupBy("bucket").agg(F.ceil(F.greatest(
        F.sum("size") / TILE_BYTES, F.count(F.lit(1)) / F.lit(TILE_ROWS))).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("bucket", "node"), F.col("parts")).cast("int")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = others.join(parts, "bucket").select("bucket", up_to("chunks").alias("chunk"), part.alias("part"),
                                                 F.lit(True).alias("asks"), "node", "label")
    asked = marked.join(parts, "bucket").select("bucket", "chunk", up_to("parts").alias("part"),
                                                F.lit(False).alias("asks"), "node", "label")
    return asking.unionByName(asked)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, class_id, kept, node)`` of every row; ``node`` is a digest of its words."""
    prints = written(fingerprints(docs, key, text), "fingerprints")
    nodes = written(prints.groupBy("node").agg(F.min("id").alias("id"), F.first("bands").alias("bands"),
                                               F.first("sketch").alias("sketch")), "nodes")
    labels = link_classes(nodes, docs, key, text, threshold)
    named = nodes.select("node", "id", F.col("node").alias("root"))
    if labels is not None:
        named = nodes.select("node", "id").join(labels, "node", "left").select(
            "node", "id", F.coalesce("label", "node").alias("root"))
    heads = named.groupBy("root").agg(F.min("id").alias("class_id"),
                                      F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("head"))
    classes = named.join(heads, "root").select(
        "node", "class_id", (F.col("head.node") == F.col("node")).alias("__head"))
    marked = prints.select("id", "node").join(classes, "node")
    rows = marked.withColumn("__row", row_key(F.col("id"), F.col("node"))).withColumn(
        "__chief", F.col("__head") & F.col("id").eqNullSafe(F.col("class_id")))
    # rows with equal id and words are repeats: one of them stays
    first = F.row_number().over(Window.partitionBy("__row").orderBy("__row")) == 1
    heads = rows.where("__chief").withColumn("kept", first)
    rest = rows.where(~F.col("__chief")).withColumn("kept", F.lit(False))
    return heads.unionByName(rest).select(F.col("id").alias("doc_id"), "class_id", "kept", "node")


def row_key(key: Column, node: Column) -> Column:
    """One string for id (it may be null) and words."""
    return F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("~")), F.hex(node))


def words_digest(text: Column) -> Column:
    """The node of a text: a 128-bit digest of its words."""

    def digest(column: pa.Array) -> pa.Array:
        import xxhash

        return pa.array([xxhash.xxh3_128_digest(b" ".join((t.as_py() or "").encode("utf-8", "replace").split()))
                         for t in column], pa.binary())

    return F.arrow_udf(digest, "binary")(text)


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stand for their classes, with all their columns."""
    kept = (near_duplicates(docs, key, text, threshold).where("kept")
            .select(row_key(F.col("doc_id"), F.col("node")).alias("__row")))
    rows = docs.withColumn("__row", row_key(F.col(key), words_digest(F.col(text)))).join(kept, "__row", "left_semi")
    nth = F.row_number().over(Window.partitionBy("__row").orderBy(F.col(text)))
    return rows.withColumn("__nth", nth).where("__nth = 1").drop("__row", "__nth")
