"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

The corpus is dealt into blocks of about ``BLOCK_BYTES``, written once, and every block is
both text to parse and reference for the others. A window of ``WINDOW`` words is the
smallest factor that counts. Its signpost is the smallest hash among the ``GRAM``-word
runs inside it, so equal windows have equal signposts and a block has far fewer of them
than windows.

1. Each block indexes itself: which signposts it has.
2. Signposts that two blocks share are sent back to those blocks.
3. Each block looks up the windows under shared signposts (its first occurrence of each;
   later ones in the same block refer to that one) in the index of all blocks, which
   answers with the earliest place (document, start) that has the window.
4. Each document is parsed greedily from the left: a factor starts where a window occurs
   earlier, and goes on while the next window continues at the same place of the same
   reference. Where it ends, windows across the border are judged by their own answers and
   start factors of their own, so no shared run is lost between two factors. The words under
   factors are removed, whether the factors themselves are returned or not.

A window goes to the index at most once per block, however often the block repeats it, so
a passage that many documents share weighs no more than the number of blocks.

Defined results: null text has no words; documents of fewer than ``WINDOW`` words lose
nothing; of equal windows the one in the smallest id stays (null ids last; rows with equal
ids are documents of their own in a fixed order); empty tables give empty results; only id
and text are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.bag_minhash import mix
from corpuskit.llm.common import blobs, drop_written, give_back, slices, written
from corpuskit.session import staging_path

WINDOW = 20
GRAM = 8
BLOCK_BYTES = 16 << 20
#: Spark takes no more buckets than this; a task then reads several blocks, one after another.
MOST_BUCKETS = 100_000
LAST = np.int64(2**63 - 1)
#: An odd multiplier and its inverse modulo 2**64: hashes of runs come from two prefix sums.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)

FACTORS = "array<struct<start:int,length:int,ref_doc:long,ref_start:int>>"


class Block:
    """The words of a block's documents in order of id, hashed, and its windows."""

    def __init__(self, rows: pa.Table):
        import xxhash

        ids = rows.column("id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, rows.column("row")[i].as_py()))
        self.ids = [ids[i] for i in order]
        text = rows.column("text")
        number: dict[bytes, int] = {}  # words are kept once, texts as numbers of words
        codes = [np.array([number.setdefault(w, len(number)) for w in (text[i].as_py() or b"").split()], np.int32) for i in order]
        self.vocabulary = list(number)
        hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
        self.size = np.array([len(w) for w in codes], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.doc = np.repeat(np.arange(len(codes), dtype=np.int32), self.size)
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        n = len(self.codes)
        del number, codes
        if n < WINDOW:
            self.at = np.zeros(0, np.int64)
            self.window = self.signpost = np.zeros(0, np.uint64)
            return
        with np.errstate(over="ignore"):
            back = np.full(n, INVERSE, np.uint64)
            back[0] = 1
            np.multiply.accumulate(back, out=back)
            back *= hashed[self.codes]
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(back, out=sums[1:])
            del back
            forth = np.full(n, FACTOR, np.uint64)
            forth[0] = 1
            np.multiply.accumulate(forth, out=forth)
            run = lambda k: mix((sums[k:] - sums[:-k]) * forth[: n - k + 1])
            window, least = run(WINDOW), run(GRAM)
            del sums, forth
        inside = self.doc[: n - WINDOW + 1] == self.doc[WINDOW - 1:]
        # the smallest of WINDOW - GRAM + 1 neighbours, by doubling
        need, have = WINDOW - GRAM + 1, 1
        while have < need:
            step = min(have, need - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        self.at = np.flatnonzero(inside)
        self.window, self.signpost = window[self.at], least[self.at]

    def first(self) -> np.ndarray:
        """For each window, the number of the block's first equal one."""
        if not len(self.at):
            return np.zeros(0, np.int64)
        _, first, same = np.unique(self.window, return_index=True, return_inverse=True)
        return first[same]

    def order(self, which: np.ndarray) -> np.ndarray:
        """The ids of the windows' documents as numbers that sort (null last)."""
        ids = np.array([LAST if i is None else i for i in self.ids], np.int64)
        return ids[self.doc[self.at[which]]]

    def offset(self, which: np.ndarray) -> np.ndarray:
        """The windows' starts inside their documents."""
        at = self.at[which]
        return at - self.start[self.doc[at]]


def blocks(docs: DataFrame, key: str, text: str, limit: int) -> tuple[DataFrame, str]:
    """The documents as ``(block, row, id, text)``, bucketed by block without moving a row; the table's name.

    There are as many buckets as blocks fit into the bytes (at least the session's shuffle partitions).
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 24
        size, row = 0, 0
        for batch in batches:
            for part in slices(batch, "text", limit // 8):
                own = sum(map(len, blobs(part, "text")))
                if size and size + own > limit:
                    block, size, row = block + 1, 0, 0
                size += own
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), pa.array(range(row, row + n), pa.int32()), *part.columns],
                    names=["block", "row", "id", "text"])
                row += n

    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("binary")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // limit))
    name = f"llm_blocks_{uuid.uuid4().hex[:12]}"
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    (rows.mapInArrow(run, "block long, row int, id long, text binary").write
     .bucketBy(min(buckets, MOST_BUCKETS), "block").option("compression", "zstd")
     .option("path", staging_path(spark, "tables", f"llm-{name}", unique=True)).saveAsTable(name))
    return spark.table(name), name


def _spots(own: Column, other: Column) -> Column:
    """The own window's number and the other's start, as one long."""
    low = F.lit((1 << 32) - 1)
    return own.bitwiseAND(F.lit(-(1 << 32))).bitwiseOR(other.bitwiseAND(low))


def _apart(answers: pa.Table) -> pa.Table:
    """The answers with window number and reference start in columns of their own again."""
    spots = np.asarray(answers.column("spots"), np.int64)
    return pa.table({"at": spots >> 32, "ref_doc": answers.column("ref_doc"), "ref_start": spots & 0xFFFFFFFF})


def _table(schema: str, **columns) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array(np.asarray(columns[n]).astype(np.int64), types[t]) for n, t in fields})


def _signposts(rows: pa.Table) -> pa.Table:
    posts = np.unique(Block(rows).signpost).view(np.int64)
    give_back()
    return _table("post long, block long", post=posts, block=np.full(len(posts), rows.column("block")[0].as_py()))


#: ``spot`` is the window's place: its number in the block times 2**32, plus its start in the document.
LOOKUPS = "window long, part int, block long, doc long, spot long"


def _lookups(rows: pa.Table, shared: pa.Table) -> pa.Table:
    """The block's first occurrence of each window under a shared signpost."""
    if not rows.num_rows or not shared.num_rows:
        return _table(LOOKUPS, window=[], part=[], block=[], doc=[], spot=[])
    block = Block(rows)
    posts = np.sort(np.asarray(shared.column("post"), np.int64).view(np.uint64))
    near = np.minimum(np.searchsorted(posts, block.signpost), len(posts) - 1)
    first = block.first()
    which = np.flatnonzero((posts[near] == block.signpost) & (first == np.arange(len(first))))
    del posts, near, first
    give_back()
    return _table(LOOKUPS, window=block.window[which].view(np.int64), part=(block.signpost[which] >> np.uint64(33)),
                  block=np.full(len(which), rows.column("block")[0].as_py()), doc=block.order(which),
                  spot=(which << 32) + block.offset(which))


def factors(known: np.ndarray, ref_doc: np.ndarray, ref_start: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The greedy parse of a block's documents from the answers for its windows: each factor's first and last window."""
    hit = np.flatnonzero(known)
    goes_on = np.zeros(len(hit), bool)
    a, b = hit[:-1], hit[1:]
    goes_on[1:] = (b == a + 1) & (owner[b] == owner[a]) & (ref_doc[b] == ref_doc[a]) & (ref_start[b] == ref_start[a] + 1)
    heads = np.flatnonzero(~goes_on)
    return hit[heads], hit[np.append(heads[1:], len(hit)) - 1] if len(hit) else hit


def _parsed(rows: pa.Table, answers: pa.Table, spans: bool) -> pa.Table:
    """What is left of each document of the block after the words under factors go, and (``spans``) its factors."""
    out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "factors")}
    if rows.num_rows:
        block = Block(rows)
        first = block.first()
        n = len(first)
        source, place = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        known = np.zeros(n, bool)
        at = np.asarray(answers.column("at"), np.int64)
        known[at] = True
        source[at], place[at] = np.asarray(answers.column("ref_doc")), np.asarray(answers.column("ref_start"))
        later = np.flatnonzero(first != np.arange(n))  # the block itself has the window earlier
        known[later] = True
        source[later], place[later] = block.order(first[later]), block.offset(first[later])
        offset = block.offset(np.arange(n))
        owner = block.doc[block.at]
        head, end = factors(known, source, place, owner)
        cover = np.zeros(len(block.doc) + WINDOW + 1, np.int64)
        np.add.at(cover, block.at[head], 1)
        np.add.at(cover, block.at[end] + WINDOW, -1)
        gone = np.cumsum(cover)[: len(block.doc)] > 0
        cut = np.searchsorted(owner[head], np.arange(len(block.ids) + 1))
        spanned = np.stack([offset[head], offset[end] - offset[head] + WINDOW, source[head], place[head]], axis=1)
        del first, later, known, source, place, offset, owner, cover
        for d, n_words in enumerate(block.size.tolist()):
            own = slice(block.start[d], block.start[d] + n_words)
            lost = gone[own]
            kept = [block.vocabulary[c] for c in block.codes[own][~lost].tolist()]
            out["doc_id"].append(block.ids[d])
            out["n_words"].append(n_words)
            out["n_removed"].append(int(lost.sum()))
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            out["factors"].append([dict(zip(("start", "length", "ref_doc", "ref_start"), f)) for f in
                                   spanned[cut[d]: cut[d + 1]].tolist()] if spans else None)
    give_back()
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()),
                     "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                     "factors": pa.array(out["factors"], kinds)})


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
                   spans: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, factors)`` of every row; a null id in ``ref_doc`` is the largest long."""
    spark = docs.sparkSession
    dealt, name = blocks(docs, key, text, block_bytes)
    try:
        posts = written(dealt.groupBy("block").applyInArrow(_signposts, "post long, block long"), "signposts")
        # a signpost comes at most once from a block
        several = F.count(F.lit(1)).over(Window.partitionBy("post")) > 1
        shared = posts.withColumn("several", several).where("several").drop("several")
        lookups = written(dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_lookups, LOOKUPS), "lookups")
        drop_written(posts)
        earliest = F.min(F.struct("doc", "block", "spot")).over(Window.partitionBy("window", "part"))
        answers = (lookups.withColumn("e", earliest).where(F.col("e.block") != F.col("block"))
                   .select("block", F.col("e.doc").alias("ref_doc"), _spots(F.col("spot"), F.col("e.spot")).alias("spots")))
        done = written(dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            lambda rows, got: _parsed(rows, _apart(got), spans),
            f"doc_id long, n_words long, n_removed long, kept_sha256 string, factors {FACTORS}"), "parsed")
        drop_written(lookups)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_written(dealt)
    return done
