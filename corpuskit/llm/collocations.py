"""Phrase collocations from a weighted de Bruijn graph of the corpus.

A text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
at blanks and tabs. The graph's edges are the longest grams, four words; an edge leads from
the node of its first three words to the node of its last three.

1. **Edges.** A task cuts its texts into grams, one starting at each word; where the piece
   ends first, the rest of the gram is an end mark. Equal grams of a few megabytes of text are
   counted before they are shipped, packed, to the bucket of their first word. The first words
   that would overfill a bucket (found by a pass over all texts) are dealt by two words, these
   by three where need be, and so on; so no bucket grows with a frequent word or passage.
2. **Flow.** A bucket adds up its edges. What flows out of the node ``a b c`` is the number of
   its occurrences, once the ends of pieces (grams with an end mark) are put back; the flow of
   ``a b`` is that of its continuations and its own ends, and so for ``a``. Only phrases with
   ``min_count`` occurrences leave the bucket. Words and pairs dealt to several buckets leave
   each with their part, and the parts are added.
3. **Unary paths.** Of the frequent edges, those that pass the whole flow of the node between
   them on to one another are one path (list ranking by pointer doubling). The edges of a path
   have one count, so a path offers it to each of its three-word phrases once, not once per edge.
4. **Scores.** A phrase is cut at every place; the parts' counts are joined to it.

All counts are exact. Null or empty texts have no words; a null language is ``und``; repeated
rows and ids count as often as they occur; an empty table gives no rows. Other columns are
not read. A word is any run of characters but the delimiters, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import blobs, drop_written, slices, written

LONGEST = 4
#: Bytes of text whose grams are counted before they are shipped.
CHUNK_BYTES = 4 << 20
#: Bytes of text whose grams make up a bucket, about.
BUCKET_BYTES = 8 << 20
#: A prefix is dealt by its next word where it has more than this share of a bucket's grams.
HEAVY_SHARE = 0.25
#: Copies of each one-word count that phrases are dealt to by hash: words are the hot parts.
WORD_SALTS = 16

_PACKED = "bucket int, lang string, words binary, grams binary, n int"


# --- in tasks: texts -> counted grams ----------------------------------------

def _tables():
    """Lower-casing and delimiter classes of a byte: 0 in a word, 1 between words, 2 between pieces."""
    import numpy as np

    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.zeros(256, dtype=np.uint8)
    kind[[32, 9]] = 1
    kind[list(b".,;:!?\n\x0b\x0c\r")] = 2
    return lower, kind


def _grams(data: bytes):
    """``(words, grams, counts)`` of a text: distinct words, and distinct rows of four word
    numbers from 1 (0 after the end of the piece) with their counts."""
    import numpy as np
    import pyarrow as pa

    lower, kind = _tables()
    text = lower[np.frombuffer(data, dtype=np.uint8)]
    sort = kind[text]
    inside = sort == 0
    zero = np.zeros(1, dtype=np.int8)
    edge = np.diff(np.concatenate((zero, inside.view(np.int8), zero)))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(start) == 0:
        return [], np.zeros((0, LONGEST), dtype=np.uint32), np.zeros(0, dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(stop - start))).astype(np.int64)
    packed = np.ascontiguousarray(text[inside])
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
    words = coded.dictionary.to_pylist()
    ids = np.asarray(coded.indices).astype(np.uint64) + np.uint64(1)
    piece = np.cumsum(sort == 2, dtype=np.int32)[start]
    gram = np.zeros((LONGEST, len(ids) + LONGEST), dtype=np.uint64)
    gram[0, :len(ids)] = ids
    for k in range(1, LONGEST):
        same = piece[k:] == piece[:len(ids) - k] if len(ids) > k else np.zeros(0, dtype=bool)
        gram[k, :len(same)] = np.where(same, ids[k:], 0)
    gram = gram[:, :len(ids)]
    return (words, *_summed(gram, np.ones(len(ids), dtype=np.int64)))


def _summed(gram, n):
    """Distinct columns of ``gram`` (four rows of numbers) in ascending order, with the sums of ``n``."""
    import numpy as np

    bits = np.uint64(32)
    low, low_rank = np.unique((gram[2] << bits) | gram[3], return_inverse=True)
    high, high_rank = np.unique((gram[0] << bits) | gram[1], return_inverse=True)
    key = (high_rank.astype(np.uint64) << bits) | low_rank.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    total = np.add.reduceat(n[order], first)
    h, w = high[key[first] >> bits], low[key[first] & np.uint64(0xFFFFFFFF)]
    mask = np.uint64(0xFFFFFFFF)
    rows = np.stack([h >> bits, h & mask, w >> bits, w & mask], axis=1).astype(np.uint32)
    return rows, total


def _prefix_hashes(words, rows, lang: str):
    """Hashes of the prefixes of one to four words of each gram; equal words give equal hashes anywhere."""
    import numpy as np
    import xxhash

    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
    own = np.concatenate((np.zeros(1, dtype=np.uint64), own))
    h = np.full(len(rows), xxhash.xxh3_64_intdigest(lang.encode()), dtype=np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for k in range(LONGEST):
            h = (h ^ own[rows[:, k]]) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(29))
            out.append(h)
    return out


def _chunks(batches, chunk: int) -> Iterator[tuple[str, bytes]]:
    """``(lang, text)`` in pieces of about ``chunk`` bytes; a text is never cut."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in (part for whole in batches for part in slices(whole, "text")):
        for lang, data in zip(batch.column(0).to_pylist(), blobs(batch, "text")):
            if not data:
                continue
            held.setdefault(lang, []).append(data)
            size[lang] = size.get(lang, 0) + len(data) + 1
            if size[lang] >= chunk:
                yield lang, b"\n".join(held.pop(lang))
                del size[lang]
            elif sum(size.values()) >= 4 * chunk:
                yield from ((k, b"\n".join(v)) for k, v in held.items())
                held, size = {}, {}
    yield from ((k, b"\n".join(v)) for k, v in held.items())


def _heavy_parts(buckets: int, chunk: int):
    """Prefixes that have a large share of a chunk's grams: ``(level, hash, load)``; level 0 has all of them."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for lang, data in _chunks(batches, chunk):
            words, rows, _ = _grams(data)
            if not len(rows):
                continue
            hashes = _prefix_hashes(words, rows, lang)
            limit = len(rows) * HEAVY_SHARE / buckets / 2
            out = [(0, 0, len(rows))]
            for level in range(1, LONGEST):
                value, load = np.unique(hashes[level - 1], return_counts=True)
                out += [(level, v, c) for v, c in zip(value[load > limit].view(np.int64).tolist(),
                                                      load[load > limit].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in
                                              enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                             names=["level", "hash", "load"])
    return run


def _packed(heavy: dict, buckets: int, chunk: int):
    """Counted grams of each chunk, packed by bucket."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for lang, data in _chunks(batches, chunk):
            words, rows, total = _grams(data)
            if not len(rows):
                continue
            bucket = _bucket(_prefix_hashes(words, rows, lang), heavy, buckets)
            order = np.argsort(bucket, kind="stable")
            bucket, rows, total = bucket[order], rows[order], total[order]
            words = np.array([b"", *words], dtype=object)
            edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            out = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                used, local = np.unique(rows[a:b], return_inverse=True)
                if used[0] != 0:  # the end mark keeps number 0
                    used, local = np.concatenate((np.zeros(1, used.dtype), used)), local + 1
                table = np.concatenate((local.reshape(-1, LONGEST).T.astype("<u4").ravel().view("<u1"),
                                        total[a:b].astype("<i8").view("<u1")))
                out.append((int(bucket[a]), lang, press.compress(b"\n".join(words[used[1:]])),
                            press.compress(table.tobytes()), b - a))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int32()))],
                names=["bucket", "lang", "words", "grams", "n"])
    return run


def _bucket(hashes, heavy: dict, buckets: int):
    """The bucket of the shortest prefix that is not heavy."""
    import numpy as np

    deal, done = hashes[-1].copy(), np.zeros(len(hashes[0]), dtype=bool)
    for level in range(1, LONGEST):
        light = ~done & ~np.isin(hashes[level - 1], heavy[level])
        deal[light] = hashes[level - 1][light]
        done |= light
    return ((deal >> np.uint64(17)) % np.uint64(buckets)).astype(np.int32)


def _flows(heavy: dict, min_count: int):
    """Buckets, sorted by number and language, to ``(lang, phrase, size, n)``; size 0 is all words."""
    def run(batches):
        import pyarrow as pa

        def one(lang, parts):
            langs, phrases, sizes, counts = [], [], [], []
            for phrase, size, n in _node_flows(lang, parts, heavy, min_count):
                langs.append(lang), phrases.append(phrase), sizes.append(size), counts.append(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                 pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())], names=["lang", "phrase", "size", "n"])

        held, of = [], None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["bucket"], row["lang"])
                if held and key != of:
                    yield one(of[1], held)
                    held = []
                of = key
                held.append((row["words"], row["grams"], row["n"]))
        if held:
            yield one(of[1], held)
    return run


def _node_flows(lang: str, parts, heavy: dict, min_count: int):
    """Phrases of a bucket with their counts: edges, then the flow out of each shorter node."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    press = zstandard.ZstdDecompressor()
    vocabulary, grams, totals, sizes = [], [], [], []
    for packed_words, packed_grams, n in parts:
        own = press.decompress(packed_words).split(b"\n")
        table = np.frombuffer(press.decompress(packed_grams), dtype="<u1")
        grams.append(table[:4 * LONGEST * n].view("<u4").reshape(LONGEST, n))
        totals.append(table[4 * LONGEST * n:].view("<i8"))
        vocabulary.append(pa.array(own, pa.large_binary()))
        sizes.append(len(own))
    coded = pa.concat_arrays(vocabulary).dictionary_encode()
    words = coded.dictionary.to_pylist()
    ids = np.asarray(coded.indices).astype(np.uint64) + np.uint64(1)
    at = np.concatenate(([0], np.cumsum(sizes)))
    grams = [np.concatenate((np.zeros(1, np.uint64), ids[at[i]:at[i + 1]]))[g] for i, g in enumerate(grams)]
    rows, total = _summed(np.concatenate(grams, axis=1), np.concatenate(totals))
    hashes = _prefix_hashes(words, rows, lang)
    words = np.array([b"", *words], dtype=object)
    yield b"", 0, int(total.sum())
    for size in range(LONGEST, 0, -1):
        # rows are sorted, so a node's out-going edges and piece ends are neighbours
        new = np.concatenate(([True], (rows[1:, :size] != rows[:-1, :size]).any(axis=1)))
        first = np.flatnonzero(new)
        flow = np.add.reduceat(total, first)
        part = np.isin(hashes[size - 1][first], heavy[size]) if size < LONGEST else np.zeros(len(first), bool)
        whole = rows[first, size - 1] != 0
        for i in np.flatnonzero(whole & (part | (flow >= min_count))).tolist():
            yield b" ".join(words[rows[first[i], :size]]), size, int(flow[i])


# --- Spark: counts, paths, scores --------------------------------------------

def phrase_counts(docs: DataFrame, min_count: int = 30, text: str = "text", lang: str = "lang",
                  bucket_bytes: int = BUCKET_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(lang, phrase, size, n)`` of all phrases of one to four words with ``min_count``
    occurrences, exact; the row of size 0 has the number of all words of the language."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(size // bucket_bytes) + 1
    heavy = heavy_prefixes(rows, buckets, chunk_bytes)
    packed = rows.mapInArrow(_packed(heavy, buckets, chunk_bytes), _PACKED)
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang")
    parts = dealt.mapInArrow(_flows(heavy, min_count), "lang string, phrase string, size int, n long")
    return parts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= min_count) | (F.col("size") == 0))


def heavy_prefixes(rows: DataFrame, buckets: int, chunk_bytes: int = CHUNK_BYTES) -> dict:
    """Per number of words, the hashes of prefixes that would overfill a bucket, as sorted arrays.

    At most ``2 * buckets / HEAVY_SHARE`` prefixes of each length can have that share, so what
    comes to the driver is bounded by the number of buckets.
    """
    import numpy as np

    parts = rows.mapInArrow(_heavy_parts(buckets, chunk_bytes), "level int, hash long, load long")
    loads = written(parts.groupBy("level", "hash").agg(F.sum("load").alias("load")), "prefixes")
    total = loads.where("level = 0").agg(F.sum("load")).first()[0] or 0
    found = loads.where((F.col("level") > 0) & (F.col("load") > total * HEAVY_SHARE / buckets / 2)).collect()
    drop_written(loads)
    return {level: np.sort(np.array([r["hash"] for r in found if r["level"] == level], dtype=np.int64).view(np.uint64))
            for level in range(1, LONGEST)}


def _words(c: Column | str) -> Column:
    return F.split(c, " ", -1)


def _part(c: Column, start, length) -> Column:
    return F.array_join(F.slice(c, start, length), " ")


def unary_paths(counts: DataFrame) -> DataFrame:
    """``(lang, words ARRAY<STRING>, n)``: the frequent edges, joined where a node passes its
    whole flow from one edge to one other.

    An edge whose first node's count equals its own count has no rival there; the same for its
    last node. All of a path lies in each text that has any of its edges, so no path is longer
    than a piece of one document, and none is a circle.
    """
    edges = counts.where(F.col("size") == LONGEST).select("lang", _words("phrase").alias("w"), "n")
    nodes = counts.where(F.col("size") == LONGEST - 1).select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    edges = edges.select("lang", "n", _part(F.col("w"), 1, LONGEST).alias("edge"),
                         _part(F.col("w"), 1, LONGEST - 1).alias("source"),
                         _part(F.col("w"), 2, LONGEST - 1).alias("target"))
    out = edges.join(nodes.withColumnRenamed("node", "source"), ["lang", "source"]).where("n = flow")
    into = edges.join(nodes.withColumnRenamed("node", "target"), ["lang", "target"]).where("n = flow")
    step = into.select("lang", F.col("target").alias("source"), F.col("edge").alias("before"))
    nexts = out.join(step, ["lang", "source"]).select("lang", "edge", "before")
    ranked = written(edges.join(nexts, ["lang", "edge"], "left").select(
        "lang", "edge", "n", F.coalesce("before", "edge").alias("head"),
        F.col("before").isNotNull().cast("long").alias("place")), "path-ranks")
    while True:
        on = ranked.select("lang", F.col("edge").alias("head"), F.col("head").alias("further"), F.col("place").alias("more"))
        moved = written(ranked.join(on, ["lang", "head"]).select(
            "lang", "edge", "n", F.col("further").alias("head"), (F.col("place") + F.col("more")).alias("place"),
            (F.col("further") != F.col("head")).alias("moved")), "path-ranks")
        drop_written(ranked)
        ranked = moved
        if ranked.where("moved").isEmpty():
            break
    last = F.element_at(_words("edge"), -1)
    paths = ranked.groupBy("lang", "head").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", last.alias("word")))).alias("tail"))
    return paths.select("lang", F.concat(F.slice(_words("head"), 1, LONGEST - 1),
                                         F.transform("tail", lambda x: x["word"])).alias("words"), "n")


def _longer(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """``(lang, phrase, longer)``: the largest count of a longer phrase that contains the phrase.

    A phrase within another is within one that is longer by a single word, and no rarer.
    """
    def windows(words: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: _part(words, i, n))

    from_paths = paths.select("lang", "n", F.explode(F.array_distinct(
        windows(F.col("words"), LONGEST - 1))).alias("phrase"))
    shorter = counts.where(F.col("size") == LONGEST - 1).select("lang", "n", _words("phrase").alias("w"))
    from_nodes = shorter.select("lang", "n", F.explode(F.array_distinct(
        windows(F.col("w"), LONGEST - 2))).alias("phrase"))
    return from_paths.unionByName(from_nodes).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 30, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its worst cut, ``n`` all words of the
    language; the score is ``floor(2000000 a / (l + r))``. Phrases within a longer one that has
    four fifths of their count are left out.
    """
    counts = written(phrase_counts(docs, min_count, text, lang), "phrases")
    paths = written(unary_paths(counts), "paths")
    wide = "decimal(38,0)"
    longer = _longer(counts, paths)
    found = counts.where("size >= 2").join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast(wide) * 5 < F.col("n").cast(wide) * 4))
    w = _words("phrase")
    cuts = found.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
            k.alias("k"), _part(w, F.lit(1), k).alias("first"), _part(w, k + 1, F.col("size") - k).alias("rest")))).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.k", "cut.first", "cut.rest",
                       F.pmod(F.xxhash64("phrase"), F.lit(WORD_SALTS)).alias("salt"))
    # a frequent word is a part of many phrases: its count is held in several copies
    copies = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(WORD_SALTS - 1))).otherwise(F.array(F.lit(-1)))
    parts = counts.where(f"size between 1 and {LONGEST - 1}").select("lang", "phrase", "n", F.explode(copies).alias("salt"))

    def with_part(rows: DataFrame, side: str, name: str) -> DataFrame:
        own = parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name), F.col("salt").cast("long").alias("s"))
        single = ~F.col(side).contains(" ")
        return rows.withColumn("s", F.when(single, F.col("salt")).otherwise(F.lit(-1)).cast("long")) \
            .join(own, ["lang", side, "s"]).drop("s")

    cuts = with_part(with_part(cuts, "first", "l"), "rest", "r")
    score = F.expr(f"(CAST(2000000 AS {wide}) * CAST(a AS decimal(20,0))) div (CAST(l AS decimal(20,0)) + r)")
    best = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select(
        "lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    ranked = _first_of_each(best, top)
    words = counts.where("size = 0").select("lang", F.col("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, cut in salted parts before they meet."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    few = rows.withColumn("near", F.row_number().over(part)).where(F.col("near") <= top).drop("near")
    whole = Window.partitionBy("lang").orderBy(*order)
    return few.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
