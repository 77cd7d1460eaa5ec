"""SentencePiece encoding and decoding by suffix-array matching.

No piece crosses from a letter into the white space before the next word, so a text
falls into segments (a run of word marks and what follows), and a batch holds few
distinct ones. Their concatenation is indexed by a suffix array (to the longest
piece's depth); a binary search of every piece of the vocabulary gives its range of
occurrences, so all edges (position, piece) of the segment lattice. Sorted by position
they are relaxed in one sweep that runs through all segments in step.

For a BPE vocabulary the relaxation rule follows from how merges work: a sequence of
pieces is the encoding of its text exactly if every two neighbours are, so at each
position one piece is right - the one that agrees with the piece before it. Whether two
pieces agree is decided by undoing their merges, latest first, and looking for a merge
across the border that would have come earlier. Segments with repeated word marks (the
vocabulary ranks such runs alike, and the leftmost wins) are merged step by step.

Defined results: null text gives null ids and null text back; empty text gives no ids
and empty text; the word mark U+2581 inside a text is read as a space, as the library
does; characters outside the vocabulary become byte pieces. Rows, ties and extra columns
pass through as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpuskit.llm.common import give_back, slices

MARK = "▁"
CHUNK_CHARS = 1 << 18
#: Segments that a worker remembers between batches, at most.
MEMORY = 200_000
NEVER = np.int64(1) << 40


class PieceModel:
    """Pieces of a BPE model, their merge trees, and the pairs that merge."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in plain}
        self.id = {p: i for i, p in self.text.items()}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.score = {i: sp.get_score(i) for i in plain}
        self.depth = max(map(len, self.text.values()))
        # a merge's rank: pieces in the order of falling score; single characters are there from the start
        order = sorted((i for i in plain if len(self.text[i]) > 1), key=lambda i: -self.score[i])
        self.rank = np.full(n + 1, -1, np.int64)
        self.rank[order] = np.arange(len(order))
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        self.sound = np.zeros(n + 1, bool)  # pieces that their own text encodes to
        self.sound[n] = True
        for i, p in self.text.items():
            if len(p) == 1:
                self.sound[i] = True
            elif set(p) != {MARK}:
                parts = self.merge(p, last=True)
                if parts:
                    self.left[i], self.right[i] = parts
                    self.sound[i] = True
        pairs = {}
        for i, p in self.text.items():
            if len(p) > 1:
                for k in range(1, len(p)):
                    if p[:k] in self.id and p[k:] in self.id:
                        pairs[self.id[p[:k]] * (n + 1) + self.id[p[k:]]] = self.rank[i]
        bits = int(16 * len(pairs)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slot_key, self.slot_rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER)
        keys = np.array(sorted(pairs), np.int64)
        for key, at in zip(keys.tolist(), self._home(keys).tolist()):
            while self.slot_key[at] >= 0:
                at = (at + 1) & (len(self.slot_key) - 1)
            self.slot_key[at], self.slot_rank[at] = key, pairs[key]
        self._index_alphabet()
        raw = [b""] * (n + 1)
        for i, p in self.text.items():
            raw[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte.items():
            raw[i] = bytes([b])
        raw[self.unknown] = " ⁇ ".encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len

    def _home(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _index_alphabet(self) -> None:
        """Dense codes for the vocabulary's characters; the sound pieces as rows of codes."""
        chars = sorted({c for p in self.text.values() for c in p})
        self.code = np.zeros(max(map(ord, chars)) + 2, np.int64)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.find_ids = np.array([i for i in self.text if self.sound[i]], np.int64)
        self.find = np.zeros((len(self.find_ids), self.depth), np.int64)
        for row, i in enumerate(self.find_ids.tolist()):
            self.find[row, : len(self.text[i])] = self.code[[ord(x) for x in self.text[i]]]
        self.length = np.ones(self.n + 1, np.int64)
        for i, p in self.text.items():
            self.length[i] = len(p)

    def merge(self, segment: str, last: bool = False):
        """The encoding by merging, best score first, leftmost on ties; ``last``: the two halves of a full merge."""
        import heapq

        part = [c for c in segment]
        nxt, prv = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list = []

        def offer(i):
            if 0 <= i and nxt[i] < len(part):
                got = self.id.get(part[i] + part[nxt[i]])
                if got is not None:
                    heapq.heappush(heap, (-self.score[got], i, part[i], part[nxt[i]]))

        for i in range(len(part)):
            offer(i)
        halves = None
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if part[i] != a or nxt[i] >= len(part) or part[nxt[i]] != b:
                continue
            j = nxt[i]
            halves, part[i], part[j], nxt[i] = (a, b), a + b, None, nxt[j]
            if nxt[j] < len(part):
                prv[nxt[j]] = i
            offer(prv[i])
            offer(i)
        done = [p for p in part if p is not None]
        if last:
            return (self.id[halves[0]], self.id[halves[1]]) if len(done) == 1 and halves else None
        return [x for p in done for x in ([self.id[p]] if p in self.id else self.bytes_of(p))]

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte.get(b, self.unknown) for b in char.encode("utf-8", "replace")]

    def crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of pieces, or NEVER."""
        key = a * (self.n + 1) + b
        at, out = self._home(key), np.full(len(key), NEVER)
        left = np.arange(len(key))
        while len(left):
            got = self.slot_key[at]
            hit = got == key[left]
            out[left[hit]] = self.slot_rank[at[hit]]
            on = ~hit & (got >= 0)
            left, at = left[on], (at[on] + 1) & (len(self.slot_key) - 1)
        return out

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``a`` then ``b`` is how their joint text is encoded."""
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        x_end, y_end = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(live):
            c = self.crossing(x, y)
            bad = (c < x_end) & (c <= y_end) & (c < NEVER)
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            back = ry >= rx  # y was made last (of equal merges the left one comes first)
            y_end, x_end = np.where(back, ry, y_end)[go], np.where(back, x_end, rx)[go]
            x, y = np.where(back, x, self.right[x])[go], np.where(back, self.left[y], y)[go]
            live = live[go]
        return good

    def suffixes(self, codes: np.ndarray):
        """The suffix array of ``codes`` to the depth of a piece.

        Characters are coded anew within what the text uses, so that a 64-bit key holds
        many; returns the positions in order, their keys, and the same keys (lowest and
        highest continuation) of the pieces that the text's characters can spell.
        """
        used = np.flatnonzero(np.bincount(codes, minlength=1)[1:]) + 1
        dense = np.zeros(len(self.code) + 1, np.uint64)
        dense[used] = np.arange(1, len(used) + 1, dtype=np.uint64)
        bits = max(1, int(len(used) + 1).bit_length())
        per = 64 // bits
        words = -(-self.depth // per)
        able = ((self.find == 0) | (dense[self.find] > 0)).all(axis=1)

        def packed(column) -> list[np.ndarray]:
            out = []
            for w in range(words):
                key = column(w * per).copy()
                for k in range(1, per):
                    key = (key << np.uint64(bits)) | column(w * per + k)
                out.append(key)
            return out

        padded = np.concatenate([dense[codes], np.zeros(words * per, np.uint64)])
        keys = packed(lambda k: padded[k: k + len(codes)])
        piece = np.zeros((int(able.sum()), words * per), np.uint64)
        piece[:, : self.depth] = dense[self.find[able]]
        low = packed(lambda k: piece[:, k])
        top = np.where(piece == 0, np.uint64((1 << bits) - 1), piece)
        high = packed(lambda k: top[:, k])
        order = np.argsort(keys[0])
        first = keys[0][order]
        tie = np.zeros(len(order) + 1, bool)
        tie[1:-1] = first[1:] == first[:-1]
        tied = np.flatnonzero(tie[1:] | tie[:-1])  # only equal first words need the others
        group = np.cumsum(~tie[:-1])[tied]
        order[tied] = order[tied][np.lexsort([k[order[tied]] for k in keys[:0:-1]] + [group])]
        return order, [k[order] for k in keys], self.find_ids[able], low, high

    def search(self, keys: list[np.ndarray], want: list[np.ndarray], after: bool) -> np.ndarray:
        """For each wanted key, how many suffixes are smaller (``after``: or equal)."""
        low = np.zeros(len(want[0]), np.int64)
        high = np.full(len(want[0]), len(keys[0]), np.int64)
        for _ in range(int(len(keys[0])).bit_length()):
            mid = (low + high) >> 1
            at = np.minimum(mid, len(keys[0]) - 1)
            less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for k, w in zip(keys, want):
                got = k[at]
                less |= same & (got < w)
                same &= got == w
            less |= same & after
            less &= low < high
            low, high = np.where(less, mid + 1, low), np.where(less | (low >= high), high, mid)
        return low

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of (distinct) segments without repeated word marks, one after the other; their numbers."""
        joined = "\0".join(segments) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        codes = self.code[np.minimum(points, len(self.code) - 1)]
        sizes = np.array([len(s) for s in segments], np.int64)
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        codes[begin + sizes] = 0  # no piece holds it
        home = np.repeat(begin, sizes + 1)  # each position's segment start
        order, keys, ids, low, high = self.suffixes(codes)
        lo, hi = self.search(keys, low, False), self.search(keys, high, True)
        count = np.maximum(hi - lo, 0)
        first = np.repeat(lo - (np.cumsum(count) - count), count)
        start = order[first + np.arange(len(first))]
        piece = np.repeat(ids, count)
        is_char = np.ones(len(codes), bool)
        is_char[begin + sizes] = False
        alone = np.ones(len(codes), bool)  # characters that are no piece
        alone[start[self.length[piece] == 1]] = False
        odd = np.flatnonzero(alone & is_char)
        start, piece = np.concatenate([start, odd]), np.concatenate([piece, np.full(len(odd), self.n)])
        offset = start - home[start]
        by = np.argsort(offset, kind="stable")
        start, piece, offset = start[by], piece[by], offset[by]
        steps = np.flatnonzero(np.diff(offset, prepend=-1, append=-1))
        last = np.full(len(codes) + 1, -1, np.int64)
        for s, e in zip(steps[:-1], steps[1:]):
            j, p = start[s:e], piece[s:e]
            if offset[s]:
                before = last[j]
                known = before >= 0
                j, p, before = j[known], p[known], before[known]
                fits = self.agree(before, p)
                j, p = j[fits], p[fits]
            last[j + self.length[p]] = p
        return self._trace(last, begin, sizes, points)

    def _trace(self, last, begin, sizes, points) -> tuple[np.ndarray, np.ndarray]:
        """Walk back from each segment's end, all segments in step; ids and their number per segment."""
        at, live, walked = begin + sizes, np.flatnonzero(sizes > 0), []
        count = np.zeros(len(sizes), np.int64)
        while len(live):
            p = last[at[live]]
            if (p < 0).any():
                raise ValueError("a position has no piece")
            at[live] -= self.length[p]
            count[live] += 1
            char = np.flatnonzero(p == self.n)  # outside the vocabulary: the code point, for now
            p[char] = -points[at[live[char]]].astype(np.int64) - 1
            walked.append((live, p))
            live = live[at[live] > begin[live]]
        stop = np.cumsum(count)
        ids = np.zeros(int(stop[-1]) if len(stop) else 0, np.int64)
        for step, (seg, p) in enumerate(walked):
            ids[stop[seg] - 1 - step] = p
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            spelled = [self.bytes_of(chr(-c - 1)) for c in ids[odd].tolist()]
            width = np.ones(len(ids), np.int64)
            width[odd] = [len(x) for x in spelled]
            wide, place = np.repeat(ids, width), np.cumsum(width) - width
            for k, x in zip(place[odd].tolist(), spelled):
                wide[k: k + len(x)] = x
            count = np.add.reduceat(np.append(width, 0), np.minimum(stop - count, len(width))) * (count > 0)
            ids = wide
        return ids.astype(np.int32), count

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of pieces (the leading word mark as a space)."""
        size = self.raw_len[ids]
        start = np.repeat(self.raw_at[ids] - (np.cumsum(size) - size), size)
        return self.raw[start + np.arange(len(start))]


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def segments(text: str) -> list[str]:
    """A text's segments, each with its word marks in front."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return [MARK + w for w in words]
    out, marks = [], ""
    for w in words:
        marks += MARK
        if w:
            out.append(marks + w)
            marks = ""
    return out + [marks] if marks else out


class _Index(dict):
    """Numbers its keys in the order of their first use."""

    def __missing__(self, key):
        got = self[key] = len(self)
        return got


class Encoder:
    """Encodes batches of texts; remembers a bounded number of segments."""

    def __init__(self, path: str):
        self.model = model(path)
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.flat, self.size, self.at = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, fresh: list[str]) -> None:
        """Add the ids of new segments, in their order."""
        marked = np.array([s.startswith(MARK * 2) for s in fresh], bool)
        plain = [s for s, m in zip(fresh, marked.tolist()) if not m]
        ids, sizes, at = [], [], 0
        while at < len(plain):
            stop, chars = at, 0
            while stop < len(plain) and (chars < CHUNK_CHARS or stop == at):
                chars += len(plain[stop]) + 1
                stop += 1
            got, size = self.model.encode_segments(plain[at:stop])
            ids.append(got)
            sizes.append(size)
            at = stop
        merged = [self.model.merge(s) for s, m in zip(fresh, marked.tolist()) if m]
        size = np.zeros(len(fresh), np.int64)
        size[~marked] = np.concatenate(sizes) if sizes else 0
        size[marked] = [len(x) for x in merged]
        flat = np.concatenate([*ids, *[np.array(x, np.int32) for x in merged]]) if fresh else np.zeros(0, np.int32)
        place = np.zeros(len(fresh), np.int64)
        by = np.concatenate([np.flatnonzero(~marked), np.flatnonzero(marked)])
        place[by] = np.cumsum(size[by]) - size[by] + len(self.flat)
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.size, self.at = np.concatenate([self.size, size]), np.concatenate([self.at, place])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > MEMORY:
            self._forget()
        codes, ends, seen = [], [], len(self.index)
        number = self.index.__getitem__
        for text in texts:
            codes.extend(map(number, segments(text)))
            ends.append(len(codes))
        self._learn(list(self.index)[seen:] if len(self.index) > seen else [])
        codes = np.array(codes, np.int64)
        each = self.size[codes]
        stop = np.cumsum(each)
        ids = self.flat[np.repeat(self.at[codes] - (stop - each), each) + np.arange(int(stop[-1]) if len(stop) else 0)]
        cut = np.concatenate([[0], stop])[np.array(ends, np.int64)]
        return np.split(ids, cut[:-1]) if len(cut) else []

    def decode(self, ids: np.ndarray) -> bytes:
        raw = self.model.decode(ids).tobytes()
        return raw[1:] if raw[:1] == b" " else raw


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """One per worker process: what a task has encoded helps the next."""
    return Encoder(path)


def _strings(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     ids: bool = True, back: bool = False) -> DataFrame:
    """``keep`` columns with ``n_pieces``, ``ids_crc32`` (ids as little-endian 32-bit), and what is asked for:
    ``ids array<int>``; ``decoded`` (the text that the ids decode to) and ``round_trip`` (it equals the text)."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    out = [*fields, T.StructField("n_pieces", T.IntegerType()), T.StructField("ids_crc32", T.LongType())]
    out += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    out += [T.StructField("decoded", T.StringType()), T.StructField("round_trip", T.BooleanType())] * back
    schema = T.StructType(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        encoder, arrow = shared_encoder(path), to_arrow_schema(schema)
        try:
            for batch in batches:
                for part in slices(batch, "__text", 1 << 20):
                    texts = _strings(part, "__text")
                    got = encoder.encode([t or "" for t in texts])
                    null = [t is None for t in texts]
                    cols = [part.column(part.schema.get_field_index(f.name)) for f in fields]
                    cols.append(pa.array([None if z else len(g) for g, z in zip(got, null)], pa.int32()))
                    cols.append(pa.array([None if z else zlib.crc32(g.astype("<u4").tobytes())
                                          for g, z in zip(got, null)], pa.int64()))
                    if ids:
                        cols.append(pa.array([None if z else g for g, z in zip(got, null)], pa.list_(pa.int32())))
                    if back:
                        text_back = [None if z else encoder.decode(g).decode("utf-8", "replace") for g, z in zip(got, null)]
                        cols.append(pa.array(text_back, pa.string()))
                        cols.append(pa.array([None if z else b == t.replace(MARK, " ")
                                              for b, t, z in zip(text_back, texts, null)], pa.bool_()))
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(f.type) if c.type != f.type else c for c, f in zip(cols, arrow)], schema=arrow)
        finally:  # segments seldom come again in another task
            encoder._forget()
            give_back()

    from pyspark.sql import functions as F

    return docs.select(*[f.name for f in fields], F.col(text).alias("__text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null."""
    schema = T.StructType([f for f in encoded.schema.fields if f.name != into] + [T.StructField(into, T.StringType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        encoder, arrow = shared_encoder(path), to_arrow_schema(schema)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            text = [None if r is None else encoder.decode(np.array(r, np.int64)).decode("utf-8", "replace") for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(f.name)) for f in schema.fields[:-1]] + [pa.array(text, pa.string())],
                schema=arrow)

    return encoded.mapInArrow(run, schema)
