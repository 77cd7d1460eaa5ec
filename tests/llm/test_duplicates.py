"""Near duplicates, repeated passages and vectors against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import bag_minhash, cross_polytope, relative_lz
from corpuskit.llm.components import components
from llm.conftest import prose


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "random", "star"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 60)],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(110)]}[shape]
    links = [(a, b) for a, b in links if a != b]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == _roots({x for p in links for x in p}, links)


# --- BagMinHash ------------------------------------------------------------------

def _bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def _near(a, b):
    union = sum((a | b).values())
    return union > 0 and sum((a & b).values()) >= 0.8 * union


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(5)
    errors = []
    for case in range(12):
        h = rng.integers(0, 2**63, 300, dtype=np.uint64)
        w1, w2 = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
        w2 = np.where(rng.random(300) < 0.7, w1, w2)
        sig = []
        for w in (w1, w2):
            own = w > 0
            sig.append(bag_minhash.signatures(1, np.zeros(own.sum(), np.int64), h[own], w[own])[0])
        true = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
        errors.append(((sig[0] == sig[1]).mean() - true) / math.sqrt(true * (1 - true) / bag_minhash.SLOTS))
    assert abs(np.mean(errors)) < 1.2 and np.max(np.abs(errors)) < 4  # unbiased, with binomial spread


def test_near_duplicates_equal_brute_force(spark, tables):
    docs = tables("documents")
    got = {r.doc_id: r for r in bag_minhash.near_duplicates(docs).collect()}
    bags = {r.doc_id: _bag(r.text) for r in docs.collect()}
    where = defaultdict(set)
    for i, b in bags.items():
        for s in b:
            where[s].add(i)
    pairs = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    roots = _roots(bags, [(a, b) for a, b in pairs if _near(bags[a], bags[b])])
    assert {i: r.class_id for i, r in got.items()} == roots
    assert {i for i, r in got.items() if r.kept} == {i for i, r in roots.items() if i == r}


def test_group_of_near_copies(spark):
    """Chains of copies: only neighbours are alike, and all are one class."""
    rng, words = random.Random(1), prose("base", 150).split()
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[rng.randrange(len(words))] = f"new{i}"
        words[rng.randrange(len(words))] = f"other{i}"
    rows += [(100 + i, prose(f"u{i}", 60)) for i in range(20)]
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bags = {i: _bag(t) for i, t in rows}
    want = _roots(bags, [(a, b) for a in bags for b in bags if a < b and _near(bags[a], bags[b])])
    assert got == want and len({got[i] for i in range(60)}) < 5


def _near_copies(n, seed=0):
    """Texts of one group: each differs in a few words from a common one, so not every pair is alike enough."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([0, 1, 2, 3])):
            words[at] = f"x{i}.{at}"
        out.append(" ".join(words))
    return out


def _brute_classes(texts):
    from collections import Counter

    bags = [Counter(zip(*[t.split()[k:] for k in range(5)])) if len(t.split()) >= 5 else Counter([tuple(t.split())]) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if both / max(sum((bags[i] | bags[j]).values()), 1) >= 0.8 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_null_ids_meet_only_texts_of_their_words(spark):
    """Two thousand null ids: no join of all with all, and classes by words alone."""
    texts = [f"text {i} " + " ".join(f"t{i}w{k}" for k in range(12)) for i in range(1000)]
    rows = [(None, t) for t in texts] * 2 + [(i, t) for i, t in enumerate(texts[:50])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = docs.select(F.col("doc_id").alias("id"), bag_minhash.words_digest(F.col("text")).alias("node")).distinct() \
        .withColumn("sketch", F.lit(b""))
    assert bag_minhash.multisets(docs, wanted.where("id is null"), "doc_id", "text").count() == 1000
    got = bag_minhash.near_duplicates(docs)
    assert got.count() == len(rows) and got.where("kept").count() == 1000
    assert got.where("class_id is null").count() == 2 * 950


def test_large_groups_of_near_copies(spark, monkeypatch):
    texts = _near_copies(220) + [f"alone {i} " + " ".join(f"a{i}b{k}" for k in range(30)) for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows in (bag_minhash.TILE_ROWS, 40):  # one tile a bucket; many chunks, and parts that ask them
        monkeypatch.setattr(bag_minhash, "TILE_ROWS", rows)
        got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()}
        assert [got[i] for i in range(len(texts))] == _brute_classes(texts)


def test_tiles_make_every_pair_that_is_not_joined(spark):
    texts = _near_copies(80, 3) + [f"z{i} " * 3 for i in range(20)]
    nodes, doc, h = bag_minhash.shingles([t.encode() for t in texts])
    d, s, count, nth = bag_minhash.weighted(doc, h)
    sketch = bag_minhash.mix(bag_minhash.signatures(len(texts), d, s, count).view(np.uint64)).astype(np.uint8)
    with np.errstate(over="ignore"):
        item = bag_minhash.mix(h + nth.astype(np.uint64) * bag_minhash.GOLDEN)
    items = [np.sort(x).tobytes() for x in np.split(item, np.searchsorted(doc, np.arange(1, len(texts))))]
    label = [b"%03d" % i for i in range(len(texts))]
    links = dict(bag_minhash.tile_links(label, sketch, items, 0.8))
    assert [int(links.get(x, x)) for x in label] == _brute_classes(texts)
    asking = np.arange(len(texts)) < 10
    got = bag_minhash.tile_links(label, sketch, items, 0.8, asking)
    assert {x for x, _ in got} <= set(label) and len(got) >= 5


def test_near_duplicates_odd_rows(spark, odd, empty):
    rows = bag_minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    of = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert of[1] == of[2] == 1 and of[3] == of[4] == of[7] == 3 and of[5] == of[6] == 5
    assert Counter(r.class_id for r in rows if r.kept) == Counter({r.class_id for r in rows})
    kept = bag_minhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.class_id for r in rows})
    assert bag_minhash.near_duplicates(empty).count() == 0


# --- relative Lempel-Ziv -----------------------------------------------------------

def _removed(rows):
    """Brute force over (id, text) in order: words, words removed, digest of the rest."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k: k + 20])
            if key in seen:
                gone[k: k + 20] = [True] * 20
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("block", [4_000, 16 << 20])
def test_passages_equal_brute_force(spark, tables, block):
    docs = tables("documents").repartition(3)
    rows = relative_lz.remove_repeats(docs, block_bytes=block).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == sorted(_removed(texts.items()))
    words = {i: t.encode().split() for i, t in texts.items()}
    for r in rows:
        covered = set()
        for f in r.factors:  # each factor is what its reference says
            assert f.length >= 20
            assert words[r.doc_id][f.start: f.start + f.length] == words[f.ref_doc][f.ref_start: f.ref_start + f.length]
            assert (f.ref_doc, f.ref_start) < (r.doc_id, f.start)
            covered |= set(range(f.start, f.start + f.length))
        assert len(covered) == r.n_removed


def test_passages_cross_factor_borders(spark):
    """A shared run that starts inside another factor is found, and one word less is not."""
    a, b, c = prose("a", 30), prose("b", 30), prose("c", 19)
    joint = " ".join(a.split()[-10:] + b.split()[:10])
    rows = [(1, a), (2, b), (3, joint), (4, a + " " + b), (5, c + " x"), (6, c + " y")]
    got = relative_lz.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=200).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == _removed(rows)
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 0, 4: 60, 5: 0, 6: 0}


def test_passages_are_removed_by_the_parse(monkeypatch):
    """Without spans, too, what goes are the words under the parse's factors."""
    a, b = prose("a", 30), prose("b", 30)
    rows = pa.table({"block": [0] * 3, "row": pa.array(range(3), pa.int32()), "id": [1, 2, 3],
                     "text": [t.encode() for t in (a, b, a + " " + b)]})
    none = pa.table({n: pa.array([], pa.int64()) for n in ("block", "at", "ref_doc", "ref_start")})
    parse, parsed = relative_lz.factors, []
    monkeypatch.setattr(relative_lz, "factors", lambda *x: parsed.append(parse(*x)) or parsed[-1])
    got = relative_lz._parsed(rows, none, False)
    assert [len(x) for x, _ in parsed] == [2] and got.column("n_removed").to_pylist() == [0, 0, 60]
    monkeypatch.setattr(relative_lz, "factors", lambda *x: tuple(y[:1] for y in parse(*x)))
    assert relative_lz._parsed(rows, none, False).column("n_removed").to_pylist() == [0, 0, 30]


def test_passages_odd_rows(spark, odd, odd_rows, empty):
    got = relative_lz.remove_repeats(odd).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=key)[:-3] == sorted(_removed(odd_rows), key=key)[:-3]
    assert sum(r.n_removed for r in got) == sum(r[2] for r in _removed(odd_rows))
    assert relative_lz.remove_repeats(empty).count() == 0


# --- cross-polytope ------------------------------------------------------------------

def _vectors(seed=4, n=400, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, dim))
    out = [base[rng.integers(40)] + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.25, 0.4]) for _ in range(n)]
    return [[float(x) for x in v.astype(np.float32)] for v in out]


def _brute(rows):
    ok = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v)
            ok[i] = x / math.sqrt(x @ x)
    ids = sorted(ok)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.95]
    count = Counter(x for p in links for x in p)
    roots = _roots([i for i, _ in rows], links)
    return {i: (count[i], roots[i], roots[i] == i) for i, _ in rows}, links


@pytest.mark.parametrize("tile", [16, 1024])
def test_vectors_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(cross_polytope, "TILE", tile)
    v = _vectors()
    rows = [(i, x) for i, x in enumerate(v)] + [(1000 + i, v[0]) for i in range(50)]
    got = cross_polytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    want, links = _brute(rows)
    found = sum(r.n_links for r in got) / 2
    assert found <= len(links) and found >= 0.99 * len(links)  # nothing below the threshold, nearly all above
    same = sum((r.n_links, r.component_id, r.kept) == want[r.vec_id] for r in got)
    assert same >= 0.98 * len(rows)


def test_table_embeddings(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in tables("embeddings").collect()]
    got = cross_polytope.near_duplicates(tables("embeddings")).collect()
    want, _ = _brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want


def test_vectors_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0, 0.0], "a"), (2, [2.0, 0.0, 0.0], "a"), (2, [2.0, 0.0, 0.0], "a"), (3, None, "b"), (4, [], "b"),
            (5, [0.0, 0.0, 0.0], "c"), (6, [nan, 1.0, 1.0], "d"), (7, [inf, 0.0, 0.0], "d"), (8, [None, 1.0, 1.0], "d"),
            (9, [1.0, 0.0], "e"), (None, [1.0, 0.0, 0.0], "f"), (10, [1e-38, 1e-38, 0.0], "g"), (11, [3e38, 3e38, 0.0], "g")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    got = cross_polytope.near_duplicates(df).collect()
    links = Counter((r.vec_id, r.n_links) for r in got)
    assert links == Counter({(1, 3): 1, (2, 3): 2, (None, 3): 1, (3, 0): 1, (4, 0): 1, (5, 0): 1, (6, 0): 1, (7, 0): 1,
                             (8, 0): 1, (9, 0): 1, (10, 1): 1, (11, 1): 1})
    part = {r.vec_id: r.component_id for r in got}
    assert part[2] == 1 and part[None] == 1 and part[11] == 10 and all(part[i] == i for i in (3, 4, 5, 6, 7, 8, 9))
    assert cross_polytope.near_duplicates(df.limit(0)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose((cross_polytope.hadamard(x) ** 2).sum(1), (x**2).sum(1))
    assert np.allclose(cross_polytope.hadamard(cross_polytope.hadamard(x)), x)
