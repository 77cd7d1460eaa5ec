"""Token ids in binary files: documents in order of id, coded in checksummed blocks.

A file set is a Parquet folder of blocks in order (part, block): the block's coded ids (see
``range_coder``), and which documents start in it with how many ids. Documents run on from
block to block within a part. A part is what one task wrote: a range of document ids.

Texts are tokenised unit by unit: a text is cut before each single space between two
non-spaces, where a byte-level pre-tokenizer always cuts; a unit that is a word with signs
behind it is cut between them, too. Each distinct word is encoded once by the tokenizers library.

Defined results: null and empty texts have the end id alone; rows with equal ids stand next
to each other, in the order of their texts; null ids come first; an empty table makes no
blocks. Only id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.llm import range_coder
from corpuskit.llm.common import slices

CUT = re.compile(r"(?<=\S) (?=\S)")
#: A white space beside a space, or a space at an end: such texts, and empty ones, are left to ``CUT``.
SPACE = r"[\x00-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}]"
ODD = f"^$|^ | $| {SPACE}|{SPACE} "
#: A word with signs behind it, and another one in the next line: the pre-tokenizer cuts there, too. Letters and signs of these ranges only.
LETTERS, SIGNS = "[A-Za-zÀ-ÖØ-öø-ɏА-яЁё]+", r"[!-&(-/:-@\[-`{-~]*"
WORDS = rf"^(?P<a>{LETTERS})(?P<b>{SIGNS})(?P<c>(?:\n{LETTERS})?)(?P<d>{SIGNS})$"
#: Distinct words that a worker remembers, at most; those that came again stay when it forgets.
MEMORY = 800_000
#: Texts that the library gets in one call.
AT_ONCE = 256
#: Bytes of text that are encoded at once: a distinct unit is cut and looked up once in them.
SLICE = 16 << 20
#: Units that the library encodes as one text.
JOINED = 64


def _units(text: str) -> list[str]:
    words = text.split()
    if words and len(text) - len("".join(words)) == len(words) - 1:  # each white space is a single character between words
        return text.split(" ")
    return CUT.split(text)


class _Memory:
    """Distinct texts with their ids."""

    def __init__(self):
        self.names = pa.array([], pa.string())
        self.flat, self.size, self.at, self.uses = np.zeros(0, np.uint16), *np.zeros((3, 0), np.int64)

    def codes(self, names: pa.Array, uses: np.ndarray, encode) -> np.ndarray:
        """The numbers of distinct texts that come ``uses`` times; ``encode`` has the ids of those that are new."""
        known = pc.index_in(names, value_set=self.names)
        new = np.asarray(pc.is_null(known))
        codes = np.array(pc.fill_null(known, 0), np.int64)
        if new.any():
            fresh = names.filter(pa.array(new))
            codes[new] = len(self.names) + np.arange(len(fresh))
            flat, size = encode(fresh)
            self.names = pa.concat_arrays([self.names, fresh])
            self.at = np.concatenate([self.at, np.cumsum(size) - size + len(self.flat)])
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
            self.uses = np.concatenate([self.uses, np.zeros(len(fresh), np.int64)])
        self.uses[codes] += uses
        return codes

    def ids(self, codes: np.ndarray) -> np.ndarray:
        return _cut(self.flat, self.at[codes], self.size[codes])

    def forget(self) -> None:
        """Keep what came again, once there is too much."""
        if len(self.names) <= MEMORY:
            return
        kept = np.flatnonzero(self.uses > 1)[: MEMORY // 2]
        self.flat, self.names, self.size = self.ids(kept), self.names.take(pa.array(kept)), self.size[kept]
        self.at, self.uses = np.cumsum(self.size) - self.size, np.zeros(len(kept), np.int64)


def _cut(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Spans of ``flat``, one after the other."""
    place = np.repeat((at - (np.cumsum(size) - size)).astype(np.int32), size)
    place += np.arange(len(place), dtype=np.int32)
    return flat[place]


def _numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct texts, the number of each one, and how often they come."""
    coded = texts.dictionary_encode()
    number = np.asarray(coded.indices)
    return coded.dictionary, number, np.bincount(number, minlength=len(coded.dictionary))


class Tokens:
    """Encodes texts with a tokenizer file, each distinct word once."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the coder takes ids below 65,536")
        self.bytes = np.zeros(1 << 16, np.int64)  # of a byte-level token: a character for each
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token)
        self.firsts, self.words = _Memory(), _Memory()  # texts' first units, and words of the others

    def _alone(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units, and how many each has."""
        got = []
        for i in range(0, len(units), AT_ONCE):  # what the library returns is large
            done = self.tokenizer.encode_batch_fast(units[i: i + AT_ONCE], add_special_tokens=False)
            got += [np.array(e.ids, np.uint16) for e in done]
        return np.concatenate([np.zeros(0, np.uint16), *got]), np.array([len(x) for x in got], np.int64)

    def _encoded(self, units: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_alone``; units from a white space to a non-space go to the library many at a time, and are told apart by the bytes of their ids."""
        units = units if isinstance(units, pa.Array) else pa.array(units, pa.string())
        together = np.asarray(pc.and_not(pc.match_substring_regex(units, "^[ \n]"), pc.match_substring_regex(units, f"{SPACE}$")))
        joined, rest = units.filter(pa.array(together)), units.filter(pa.array(~together)).to_pylist()
        if len(joined) < 2:
            return self._alone(units.to_pylist())
        runs = pa.ListArray.from_arrays(pa.array([*range(0, len(joined), JOINED), len(joined)], pa.int32()), joined)
        flat, _ = self._alone(pc.binary_join(runs, "").to_pylist())
        stop = np.cumsum(self.bytes[flat])
        ends = np.cumsum(np.asarray(pc.binary_length(joined)), dtype=np.int64)
        last = np.searchsorted(stop, ends)
        if stop[-1] != ends[-1] or (stop[last] != ends).any():  # not the bytes of the texts
            return self._alone(units.to_pylist())
        size = np.empty(len(units), np.int64)
        size[together] = np.diff(last, prepend=-1)
        other, size[~together] = self._alone(rest)
        if not len(other):
            return flat, size
        ids, own = np.empty(int(size.sum()), np.uint16), np.repeat(together, size)
        ids[own], ids[~own] = flat, other
        return ids, size

    def _by_words(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_alone``, of units after a space: their words and signs are encoded once."""
        cut = pc.extract_regex(units, WORDS)
        whole = np.asarray(pc.is_null(cut))
        given = pa.array(~whole)
        a, b, c, d = (f.filter(given) for f in cut.flatten())
        rest = units.filter(pa.array(whole))
        n = len(a)
        spaced = [pc.binary_join_element_wise(" ", x, "") for x in (a, rest)]
        names, number, uses = _numbered(pa.concat_arrays([spaced[0], b, c, d, spaced[1]]))
        empty = np.asarray(pc.equal(names, ""))
        got = np.empty(len(names), np.int64)
        got[empty] = -1
        got[~empty] = self.words.codes(names.filter(pa.array(~empty)), uses[~empty], self._encoded)
        parts = np.full((len(units), 4), -1)
        parts[~whole] = got[number[: 4 * n]].reshape(4, n).T
        parts[whole, 0] = got[number[4 * n:]]
        size = (np.append(self.words.size, 0)[parts]).sum(axis=1)
        parts = parts.reshape(-1)
        return self.words.ids(parts[parts >= 0]), size

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        for memory in (self.firsts, self.words):
            memory.forget()
        col = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        odd = np.asarray(pc.match_substring_regex(col, ODD))
        plain = pc.split_pattern(col.filter(pa.array(~odd)), " ")
        slow = [_units(t) if t else [] for t in col.filter(pa.array(odd)).to_pylist()]
        n = np.zeros(len(col), np.int64)
        n[~odd], n[odd] = np.asarray(pc.list_value_length(plain)), [len(u) for u in slow]
        names, number, _ = _numbered(pa.concat_arrays([plain.flatten(), pa.array([u for x in slow for u in x], pa.string())]))
        order, own = np.empty(len(number), np.int32), np.repeat(odd, n)
        there = len(own) - int(own.sum())
        order[~own], order[own] = number[:there], number[there:]
        start = (np.cumsum(n) - n)[n > 0]
        first, place, times = _numbered(names.take(pa.array(order[start])))
        firsts = self.firsts.codes(first, times, lambda x: self._alone(x.to_pylist()))[place]
        flat, each = self._by_words(names)
        size, at = each[order], (np.cumsum(each) - each)[order]
        size[start], at[start] = self.firsts.size[firsts], self.firsts.at[firsts] + len(flat)
        ids = _cut(np.concatenate([flat, self.firsts.flat]), at, size)
        cut = np.concatenate([[0], np.cumsum(size)])[np.cumsum(n)]
        return np.split(ids, cut[:-1]) if len(cut) else []


@lru_cache(maxsize=1)
def shared_tokens(path: str) -> Tokens:
    """One per worker process: what a task has encoded helps the next."""
    return Tokens(path)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, add ``end_id``, and write the ids in the order of ``key``."""
    kind = docs.schema[key].dataType.simpleString()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, part, block = shared_tokens(tokenizer), TaskContext.get().partitionId(), 0
        size = range_coder.BLOCK_IDS
        waiting: list[np.ndarray] = []
        length, starts = 0, []  # ids that wait; (id, ids, place among them) of the documents that start there

        def flush(blocks: int) -> pa.RecordBatch:
            nonlocal waiting, length, starts, block
            ids = np.concatenate(waiting)
            cut = [ids[i * size: (i + 1) * size] for i in range(blocks)]
            rest = ids[blocks * size:]
            coded = range_coder.encode(cut)
            own: list[list] = [[] for _ in cut]
            for d, n, at in starts:
                if at < blocks * size:
                    own[at // size].append({"doc_id": d, "n": n})
            starts = [(d, n, at - blocks * size) for d, n, at in starts if at >= blocks * size]
            done = pa.RecordBatch.from_arrays([
                pa.array([part] * len(cut), pa.int32()), pa.array(range(block, block + len(cut)), pa.int64()),
                pa.array([len(c) for c in cut], pa.int32()),
                pa.array(own, pa.list_(pa.struct([("doc_id", key_type), ("n", pa.int64())]))),
                pa.array(coded, pa.binary())], names=["part", "block", "n_ids", "docs", "payload"])
            block, waiting, length = block + len(cut), [rest], len(rest)
            return done

        for batch in batches:
            key_type = batch.schema.field(0).type
            for piece in slices(batch, "__text", SLICE):
                got = tokens.encode(piece.column(1))
                for d, ids in zip(piece.column(0).to_pylist(), got):
                    starts.append((d, len(ids) + 1, length))
                    waiting += [ids, np.array([end_id], np.uint16)]
                    length += len(ids) + 1
                if length >= size:
                    yield flush(length // size)
        if length:
            yield flush(1)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__text"))
    spread = F.xxhash64("__text")  # rows of one id may go to many tasks
    (rows.repartitionByRange(parts, "doc_id", spread).sortWithinPartitions("doc_id", spread, "__text")
     .mapInArrow(run, f"part int, block long, n_ids int, docs array<struct<doc_id:{kind},n:long>>, payload binary")
     .write.option("compression", "none").parquet(path))


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document from its blocks, with ``ids array<int>`` if asked for."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list = []  # documents that have started: [id, ids to come, start, ids, crc, pieces]
        part, place = None, 0

        def read(row: dict) -> pa.RecordBatch:
            nonlocal part, place
            got, done = range_coder.decode([row["payload"]])[0], []
            if row["part"] != part:
                if open_:
                    raise ValueError("a part of the token files is cut short")
                part, place = row["part"], 0
            at = place
            for d in row["docs"]:
                last = open_[-1] if open_ else None
                start = last[2] + last[3] if last else at
                open_.append([d["doc_id"], d["n"], start, d["n"], 0, []])
            at = closed = 0
            while closed < len(open_) and at < len(got):
                doc = open_[closed]
                piece = np.ascontiguousarray(got[at: at + doc[1]], "<u4")
                at += len(piece)
                doc[1] -= len(piece)
                doc[4] = zlib.crc32(piece, doc[4])
                if ids:
                    doc[5].append(piece.astype(np.int32))
                if not doc[1]:
                    done.append((part, doc[0], doc[2], doc[3], doc[4], np.concatenate(doc[5]) if ids else None))
                    closed += 1
            del open_[:closed]
            place += len(got)
            cols = list(zip(*done)) or [()] * 6
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int32()), pa.array(cols[1], key_type), pa.array(cols[2], pa.int64()),
                pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.list_(pa.int32()))],
                names=["part", "doc_id", "start", "n_tokens", "ids_crc32", "ids"])

        key_type = pa.int64()
        for batch in batches:
            key_type = batch.schema.field("docs").type.value_type.field("doc_id").type
            for at in range(batch.num_rows):  # a block at a time is in Python
                yield read(batch.slice(at, 1).to_pylist()[0])

    ordered = blocks.repartitionByRange(parts, "part").sortWithinPartitions("part", "block")
    docs = ordered.select("part", "docs", "payload").mapInArrow(
        run, f"part int, doc_id {kind}, start long, n_tokens long, ids_crc32 long, ids array<int>")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per part, as many as shuffle partitions
               .select(F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")))
    out = docs.join(F.broadcast(offsets), F.col("part") == F.col("__part")).withColumn(
        "start", F.col("start") + F.col("__before")).drop("part", "__part", "__before")
    return out if ids else out.drop("ids")
