"""Corpus laws: encoding, subsets, bag of words, fixpoint, split, publish round trip."""

from pyspark.sql import functions as F

from corpuskit.operators import corpus as C
from corpuskit.operators import split as S
from corpuskit.operators import text as T
from corpuskit.operators.ordinal import with_ordinal
from corpuskit.operators.prune import prune_fixpoint
from corpuskit.plans.q_order import brand_corpus
from corpuskit.plans.q_text import text_corpus
from corpuskit.session import staging_path
from corpuskit.sources import published as PUB
import model


def test_encode_null_is_a_category(spark):
    vals = spark.createDataFrame([("d1", ["a", None, "a"]), ("d2", None), ("d3", ["b"])],
                                 "doc_id string, vals array<string>")
    a, c = C.encode(vals, "f")
    assert sorted(((r.doc_id, r.uri) for r in a.collect()), key=repr) == \
        sorted([("d1", None), ("d1", "a"), ("d3", "b")], key=repr)
    assert [(r.idx, r.uri) for r in c.orderBy("idx").collect()] == [(0, None), (1, "a"), (2, "b")]


def test_subsets_keep_columns_and_rerank(spark, sf):
    c = text_corpus(spark, sf)
    n_cats = c.categories.count()
    sub = C.subset_docs(c, c.docs.limit(5).select("doc_id"))
    assert sub.categories.count() == n_cats
    keep = c.categories.where(F.col("idx") % 2 == 1).select("uri")
    s2 = C.subset_categories(c, "topic", keep)
    idx = [r.idx for r in s2.categories.orderBy("idx").collect()]
    assert idx == list(range(len(idx)))
    try:
        C.subset_categories(c, "nope", keep)
        raise AssertionError("unknown field accepted")
    except ValueError:
        pass


def test_bow_length_law_and_true_counts(spark, sf):
    c = T.bag_of_words(text_corpus(spark, sf))
    lens = {r.doc_id: r.n for r in c.bow.groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    toks = {r.doc_id: len(r.tokens) for r in c.docs.collect()}
    for d, n in toks.items():
        assert lens.get(d, 0) == n
    one = c.with_(docs=spark.createDataFrame([("d", "x " * 300, ["x"] * 300)], "doc_id string, raw_text string, tokens array<string>"))
    assert T.bag_of_words(one).bow.first().n == 300
    assert T.bag_of_words(one, max_count=255).bow.first().n == 255


def test_repetition_filter_runs(spark):
    rows = [("a", "so so so good good day so".split()), ("b", []), ("c", None), ("d", ["hm"] * 7), ("e", ["one"])]
    docs = spark.createDataFrame(rows, "doc_id string, tokens array<string>")
    out = {r.doc_id: r.tokens for r in T.repetition_filter(docs, 3, 2).collect()}
    assert out == {"a": "so so good good day so".split(), "b": [], "c": None, "d": ["hm", "hm"], "e": ["one"]}
    out = {r.doc_id: r.tokens for r in T.repetition_filter(docs, 2, 1).collect()}
    assert out["a"] == "so good day so".split() and out["d"] == ["hm"]
    plan = T.repetition_filter(docs, 3, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_language_vote_and_tags_are_row_local(spark):
    docs = spark.createDataFrame([("a", ["Der", "and", "die"]), ("b", ["zzz"]), ("c", None), ("d", ["the", "der"])],
                                 "doc_id string, tokens array<string>")
    voted = T.language_vote(docs)
    assert {r.doc_id: r.language for r in voted.collect()} == {"a": "de", "b": None, "c": None, "d": "de"}
    assert "Exchange" not in voted._jdf.queryExecution().executedPlan().toString()
    tagged = docs.withColumn("t", F.transform("tokens", lambda w: F.struct(w.alias("token"), F.upper(F.substring(w, 1, 1)).alias("tag"))))
    kept = T.run_pipeline(tagged, [lambda d: T.drop_tags(d, ["D"], tagged_col="t")])
    assert {r.doc_id: r.tokens for r in kept.collect()} == {"a": ["and"], "b": ["zzz"], "c": None, "d": ["the"]}


def test_tagged_tokens_keep_what_earlier_steps_left(spark):
    from corpuskit.plans.jobs import default_pipeline

    tagged = "array<struct<token:string,tag:string>>"
    rows = [("a", ["x"] * 2 + ["der", "y"], [("x", "NOUN")] * 6 + [("der", "DET"), ("y", None)]),
            ("b", ["der", "z"], [("der", "PRON"), ("der", "NOUN"), ("q", "NOUN"), ("z", "NOUN")]),
            ("c", ["new", "der"], [("der", "DET")]), ("d", None, [("x", "NOUN")]), ("e", ["x"], None), ("f", [], [("x", "NOUN")])]
    docs = spark.createDataFrame(rows, f"doc_id string, tokens array<string>, t {tagged}")
    want = {"a": ["x", "x", "y"], "b": ["z"], "c": ["new"], "d": None, "e": ["x"], "f": []}
    assert {r.doc_id: r.tokens for r in T.drop_tags(docs, ["DET", "PRON"], tagged_col="t").collect()} == want
    assert {r.doc_id: r.tokens for r in T.drop_tags(docs.drop("tokens"), ["DET"], tagged_col="t").collect()}["a"] == ["x"] * 6 + ["y"]


def test_training_pipeline_drops_tagged_words(spark):
    from corpuskit.plans.jobs import default_pipeline

    texts = ["The cat and the dog of x 12 " + "no " * 5 + "ho " * 6 + "end"] * 12
    docs = spark.createDataFrame([(str(i), t + f" w{i}") for i, t in enumerate(texts)], "doc_id string, raw_text string")
    steps = default_pipeline()
    done = T.run_pipeline(docs, steps[:5]).collect()
    assert all(r.tokens == "cat dog 12 ho ho end".split() + [f"w{r.doc_id}"] and r.language == "en" for r in done)
    own = docs.withColumn("mine", F.transform(F.split("raw_text", " +"), lambda w: F.struct(w.alias("token"), F.when(
        w.startswith("w"), "DET").otherwise("NOUN").alias("tag"))))
    done = T.run_pipeline(own, default_pipeline(tagged_col="mine")[:5]).collect()
    assert all(r.tokens == "The cat and the dog of x 12 no no ho ho end".split() for r in done)
    assert {r.tokens[0] for r in T.run_pipeline(docs, default_pipeline(lambda ws: ["X"] * len(ws), ())[:5]).collect()} == {"The"}
    with __import__("pytest").raises(Exception, match="1 tags for"):
        T.run_pipeline(docs, default_pipeline(lambda ws: ["X"])[:5]).collect()


def test_ordinal_is_dense_and_ordered(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        df = spark.range(0, 200_000, 1, 7).select(F.xxhash64("id").alias("k"), F.lpad(F.col("id").cast("string"), 80, "x").alias("p"))
        got = with_ordinal(df, ["k"], "ord")
        n, distinct, low, high = got.agg(F.count("*"), F.countDistinct("ord"), F.min("ord"), F.max("ord")).first()
        assert (n, distinct, low, high) == (200_000, 200_000, 0, 199_999)
        keys = [r.k for r in got.where("ord < 5000").orderBy("ord").select("k").collect()]
        assert keys == sorted(r.k for r in df.orderBy("k").limit(5000).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_vocabulary_of_many_levels(spark):
    from conftest import records
    from corpuskit.operators.vocab import concept_nodes

    node = {"id": "c0"}
    for i in range(1, 105):
        node = {"id": f"c{i}", "narrower": [node]}
    got = concept_nodes(records(spark, [{"id": "root", "hasTopConcept": [node]}])).collect()
    assert len(got) == 106 and {(r.id, r.parent) for r in got if r.depth > 1} == {(f"c{i}", f"c{i + 1}") for i in range(104)}


def test_hot_words_stay_out_of_exchanges(spark):
    """Tokens of words above the rate are judged in their rows; a plan shuffles none of them."""
    from corpuskit.operators import hot as H

    rows = [(f"d{i}", ["the", "of"] * 3 + [f"w{i % 5}", "the", f"x{i}"]) for i in range(40)] + [("n", None), ("e", [])]
    docs = spark.createDataFrame(rows, "doc_id string, tokens array<string>")
    got = {r.doc_id: r.tokens for r in T.df_interval(docs, 2, 0.25).collect()}
    assert got == {**{f"d{i}": [f"w{i % 5}"] for i in range(40)}, "n": [], "e": []}
    words = spark.createDataFrame([("w1",), ("of",)], "word string")
    kept = H.judge_tokens(docs, words, ["the", "of"])
    assert {r.doc_id: r.tokens for r in kept.collect()}["d1"] == ["of", "of", "of", "w1"]
    exploded = docs.select(F.explode("tokens").alias("word"))
    assert sorted(r.word for r in H.keep_words(exploded, words, ["the", "of"]).collect()) == sorted(
        w for _, ts in rows for w in ts or [] if w in ("w1", "of"))
    assert {r.doc_id: r.tokens for r in H.judge_tokens(docs, words, ["the"], keep=False).collect()}["d1"] == ["the"] * 4 + ["x1"]
    plan = H.judge_tokens(docs, words, ["the", "of"])._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(filter(" in plan and "INSET" in plan.upper() or " IN (" in plan.upper()


def test_a_million_free_keywords_are_ranked_by_many_tasks(spark):
    uris = spark.range(0, 1_000_000, 1, 8).select(F.lit("kw").alias("field"), F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("uri"))
    uris = uris.unionByName(spark.createDataFrame([("other", None), ("other", "b")], "field string, uri string"))
    got = C.category_index(uris)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString().split("__off")[0].replace("WindowSpec", "")
    n, low, high, distinct = got.where("field = 'kw'").agg(F.count("*"), F.min("idx"), F.max("idx"), F.countDistinct("idx")).first()
    assert (n, low, high, distinct) == (1_000_000, 0, 999_999, 1_000_000)
    assert [(r.uri, r.idx) for r in got.where("field = 'other'").orderBy("idx").collect()] == [(None, 0), ("b", 1)]


def test_sparse_import_explodes_only_ones(spark):
    df = spark.createDataFrame([("0" * 5000 + "1" + "0" * 200 + "11",), ("",), (None,), ("0000",), ("1",)], "b string")
    got = df.select(F.explode(PUB.ones_of(F.col("b"))).alias("i")).collect()
    assert sorted(r.i for r in got) == [0, 5000, 5201, 5202]


def test_fixpoint_matches_model(spark, sf):
    c = T.bag_of_words(text_corpus(spark, sf))
    bow = {}
    for r in c.bow.collect():
        bow.setdefault(r.doc_id, {})[r.word] = r.n
    for r in c.docs.select("doc_id").collect():
        bow.setdefault(r.doc_id, {})
    cats = {}
    for r in c.assignments.collect():
        cats.setdefault(r.doc_id, set()).add(r.uri)
    expect = model.fixpoint(bow, cats, 10, 3, 4)
    got = {r.doc_id for r in prune_fixpoint(c, 10, 3, 4).docs.collect()}
    assert got == expect


def test_split_matches_sequential_walk(spark, sf):
    c = brand_corpus(spark, sf)
    doc_cats = {}
    for r in c.assignments.collect():
        doc_cats.setdefault(r.doc_id, set()).add(r.uri)
    import hashlib

    keys = {d: hashlib.md5(f"0:{d}".encode()).hexdigest() for d in doc_cats}
    expect = model.greedy_split(doc_cats, keys, 0.3)
    for tail in (S.TAIL_ROWS, 300, 0):  # mostly walked, mostly decided in passes, passes alone
        assert {r.doc_id for r in S.split_pruned(c, "brand", 0.3, 0, tail).collect()} == expect


def test_split_passes_follow_conflicts_not_categories(spark, monkeypatch):
    """Documents without a common category are decided together, however many categories there are."""
    import hashlib

    rows = [(f"d{i}", f"c{i % 60}") for i in range(600)] + [(f"d{i}", None) for i in range(0, 600, 7)]
    a = spark.createDataFrame(rows, "doc_id string, uri string").selectExpr("'f' AS field", "doc_id", "uri")
    docs = a.select("doc_id").distinct().selectExpr("doc_id", "'' AS raw_text", "false AS editor", "array() AS test_fields")
    c = C.Corpus(docs=docs, assignments=a, categories=C.attach_labels(C.category_index(a.select("field", "uri").distinct()), None), fields=("f",))
    passes, plain = [], S._pass
    monkeypatch.setattr(S, "_pass", lambda r: passes.append(1) or plain(r))
    got = {r.doc_id for r in S.split_pruned(c, "f", 0.5, 0, 0).collect()}
    cats = {}
    for d, u in rows:
        cats.setdefault(d, set()).add("" if u is None else u)
    assert got == model.greedy_split(cats, {d: hashlib.md5(f"0:{d}".encode()).hexdigest() for d in cats}, 0.5)
    assert 1 <= len(passes) <= 12


def test_publish_import_round_trip(spark, sf):
    c = text_corpus(spark, sf)
    c = c.with_(docs=T.language_vote(c.docs))
    target = staging_path(spark, "test-publish", unique=True)
    paths = PUB.publish(c, target, "x")
    back = PUB.import_published(spark, paths["data"], paths["metadata"], paths["processed_text"])
    a = sorted((r.field, r.doc_id, r.uri) for r in c.assignments.collect())
    b = sorted((r.field, r.doc_id, r.uri) for r in back.assignments.collect())
    assert a == b
    t1 = {r.doc_id: (r.raw_text, list(r.tokens)) for r in c.docs.collect()}
    t2 = {r.doc_id: (r.raw_text, list(r.tokens)) for r in back.docs.collect()}
    assert t1 == t2


def test_tagging_holds_one_document_in_python():
    import tracemalloc

    import pyarrow as pa

    from corpuskit.operators.text import closed_class_tags, tagged_lists

    docs = [[f"w{i}{j}" for j in range(200)] for i in range(1000)] + [None, [], ["der", "9", "x"]]
    tokens = pa.array(docs, pa.list_(pa.string())).slice(1)
    tracemalloc.start()
    got = tagged_lists(tokens, closed_class_tags)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000  # 200,000 words and their tags as Python objects take ten times that
    assert got.to_pylist() == [None if d is None else [
        {"token": w, "tag": t} for w, t in zip(d, closed_class_tags(d))] for d in docs[1:]]


def test_tagged_words_leave_in_slices(spark, monkeypatch):
    """A batch's documents leave the tagger in slices of few words; each document keeps its own words, null lists stay null."""
    import pyarrow as pa

    from corpuskit.operators import text as X

    docs = [["a", "b"], None, [], ["c"], [f"w{i}" for i in range(9)], None, ["d", "9"], []]
    tokens = pa.array([["x"], *docs], pa.list_(pa.string())).slice(1)
    pieces = list(X.word_slices(tokens, 3))
    assert [p for piece in pieces for p in piece.to_pylist()] == docs
    assert all(len(p) == 1 or sum(len(d or []) for d in p.to_pylist()) <= 3 for p in pieces) and len(pieces) == 3
    assert [len(p) for p in X.word_slices(tokens.slice(0, 0), 3)] == [0]
    monkeypatch.setattr(X, "TAGGED_WORDS", 3)
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id int, tokens array<string>").coalesce(1)
    got = {r.doc_id: r.tagged for r in X.tag_tokens(rows, lambda ws: [f"{len(ws)}{w}" for w in ws]).collect()}
    assert {k: v and [(t.token, t.tag) for t in v] for k, v in got.items()} == {
        k: d and [(w, f"{len(d)}{w}") for w in d] for k, d in enumerate(docs)}


def test_split_writes_no_keys(spark, monkeypatch):
    """Keys follow from the documents: no table of the split carries them; repeated assignments count as rows."""
    import hashlib

    rows = [(f"d{i}", f"c{i % 7}") for i in range(300)] + [(f"d{i}", f"c{i % 5}") for i in range(300) if i % 7 != i % 5]
    a = spark.createDataFrame(rows, "doc_id string, uri string").selectExpr("'f' AS field", "doc_id", "uri")
    docs = a.select("doc_id").distinct().selectExpr("doc_id", "'' AS raw_text", "false AS editor", "array() AS test_fields")
    c = C.Corpus(docs=docs, assignments=a, categories=C.attach_labels(C.category_index(a.select("field", "uri").distinct()), None), fields=("f",))
    written, plain = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, name: written.append(df.columns) or plain(df, name))
    cats = {}
    for d, u in rows:
        cats.setdefault(d, set()).add(u)
    keys = {d: hashlib.md5(f"0:{d}".encode()).hexdigest() for d in cats}
    for tail in (S.TAIL_ROWS, 0):
        assert {r.doc_id for r in S.split_pruned(c, "f", 0.3, 0, tail).collect()} == model.greedy_split(cats, keys, 0.3)
    assert written and not [cols for cols in written if "key" in cols and "doc_id" in cols]


def test_small_word_tables_shuffle_no_rows(spark, monkeypatch):
    from corpuskit.operators import hot as H

    rows = spark.createDataFrame([("d1", "a"), ("d1", "b"), ("d2", "c"), ("d2", None), ("d3", "a")], "doc_id string, word string")
    words, rest = (spark.createDataFrame([(w,) for w in ws], "word string") for ws in (["a", "a"], ["b", "c"]))
    want = {True: ["a", "a"], False: ["None", "b", "c"]}
    for small, others in ((10, None), (0, None), (1, rest), (0, rest)):
        monkeypatch.setattr(H, "SMALL_WORDS", small)
        for keep in (True, False):
            got = H.keep_words(rows, words, ["a"], keep=keep, others=others)
            assert sorted(str(r.word) for r in got.collect()) == want[keep]
    monkeypatch.setattr(H, "SMALL_WORDS", 1)
    two = spark.createDataFrame([("a",), ("x",)], "word string")  # two words: only the other table, of one word, is small
    got = H.keep_words(rows.where("word IN ('a', 'b')"), two, [], keep=True, others=words.selectExpr("'b' AS word"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert [r.word for r in got.collect()] == ["a", "a"]
