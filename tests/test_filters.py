"""Metamorphic filter laws: a minimal accepted record stays accepted under
irrelevant mutations and is rejected under relevant ones."""

import copy

from pyspark.sql import functions as F

from conftest import records
from corpuskit.functions import predicates as P

BASE = {"nodeRef": {"storeRef": {"protocol": "workspace"}}, "type": "ccm:io",
        "properties": {"cm:edu_metadataset": "mds_oeh"}, "aspects": []}


def _eval(spark, recs, f):
    rec = P.Record(F.col("v"))
    rows = records(spark, recs).select("rid", f(rec).alias("ok")).collect()
    return [r["ok"] for r in sorted(rows, key=lambda r: r["rid"])]


def _with(path, value, base=BASE):
    r = copy.deepcopy(base)
    node = r
    keys = path.split(".")
    for k in keys[:-1]:
        node = node.setdefault(k, {})
    node[keys[-1]] = value
    return r


def test_catalogue_filter_laws(spark):
    bare = copy.deepcopy(BASE)
    del bare["aspects"]
    accepted = [BASE, bare, _with("rating", 4), _with("aspects", ["cm:auditable"]), _with("type", ["sys:base", "ccm:io"])]
    rejected = [{}, _with("type", "ccm:saved_search"), _with("nodeRef.storeRef.protocol", "deleted"),
                _with("properties.cm:edu_metadataset", 77), _with("aspects", ["cm:auditable", "ccm:collection"]),
                _with("aspects", ["ccm:collection_io_reference"])]
    assert _eval(spark, accepted, P.catalogue_filter) == [True] * len(accepted)
    assert _eval(spark, rejected, P.catalogue_filter) == [False] * len(rejected)


def test_public_and_editor_filters(spark):
    def shelf(**props):
        return {"collections": [17, {"properties": props}]}

    readers = {"Read": ["GROUP_EVERYONE"]}
    recs = [{"permissions": readers}, {"collections": [{"permissions": readers}]}, shelf(**{"cm:title": "Redaktionsbuffet"}),
            shelf(**{"cm:title": "Regal 4"}), {"permissions": {"Read": "GROUP_EVERYONE and more"}}, {"permissions": {"Write": ["GROUP_EVERYONE"]}}]
    assert _eval(spark, recs, P.public_filter) == [True, True, False, False, False, False]
    assert _eval(spark, recs, P.editor_filter) == [False, False, True, False, False, False]


def test_language_filter_rules(spark):
    f = P.language_filter(["de", "en"])
    recs = [{}, {"properties": {"cclom:general_language": "de"}},
            {"properties": {"cclom:general_language": "fr"}},
            {"properties": {"cclom:general_language": ["de", "en"]}},
            {"properties": {"cclom:general_language": ["de", None]}},
            {"properties": {"cclom:general_language": []}},
            {"properties": {"cclom:general_language": None}}]
    assert _eval(spark, recs, f) == [True, True, False, True, False, True, True]
    assert _eval(spark, recs, P.language_filter([])) == [True] * len(recs)


def test_labeled_filter_truthiness(spark):
    f = P.labeled_filter(["a"])
    empty = ["", 0, 0.0, [], None, {"inner": "v"}]
    full = ["label", -3, 0.25, [""], [None, "q"]]
    assert _eval(spark, [{"a": x} for x in empty] + [{}], f) == [False] * 7
    assert _eval(spark, [{"a": x} for x in full], f) == [True] * 5


def test_len_filter(spark):
    f = P.len_filter(["a", "b"], [3, 2], multi_field_semantics="all")
    long_a, short_a, long_b = {"a": "four"}, {"a": "no"}, {"b": ["p", "q", "r"]}
    recs = [long_a | long_b, short_a | long_b, long_a, long_b, {"a": ["i", "j", "k"], "b": "uv"}, {"a": 4711, "b": "uv"}]
    assert _eval(spark, recs, f) == [True, False, False, False, True, False]
    assert _eval(spark, recs, P.len_filter([], 5)) == [True] * len(recs)


def test_negation_and_composition(spark):
    recs = [BASE, _with("type", "x")]
    assert _eval(spark, recs, P.negated(P.catalogue_filter)) == [False, True]
    both = P.comp(P.catalogue_filter, P.collections_filter, comp_semantics="all")
    either = P.comp(P.catalogue_filter, P.collections_filter)
    assert _eval(spark, recs, both) == [False, False]
    assert _eval(spark, recs, either) == [True, False]


def _extracted(spark, recs, *filters, **kw):
    from corpuskit.sources.records import extract_table

    out = extract_table(records(spark, recs), {"a": "a"}, filters=filters, keep=["rid"], **kw)
    return out, sorted(r["rid"] for r in out.select("rid").collect())


def test_python_filters_mix_with_columns(spark):
    recs = [{"a": "x", "b": [1, 2]}, {"a": None, "b": []}, {"a": ["x", "y"], "b": 3}, {}, {"a": 1.5, "b": [None, "z"]}]
    has_x = P.python_predicate(lambda v: v == "x", "a")
    all_x = P.python_predicate(lambda v: v == "x", "a", "all")
    two = P.python_predicate(lambda v: v == "x", "a", lambda flags: sum(flags) < 2)
    listed = P.python_filter(lambda a, b: isinstance(b, list), ["a", "b"])
    column = P.get_filter_with_basic_predicate(P.eq("x"), "a")
    assert _extracted(spark, recs, has_x)[1] == [0, 2]
    assert _extracted(spark, recs, all_x)[1] == [0]
    assert _extracted(spark, recs, two)[1] == [0, 2]
    assert _extracted(spark, recs, P.negated(has_x))[1] == [1, 3, 4]
    assert _extracted(spark, recs, listed)[1] == [0, 1, 4]
    assert _extracted(spark, recs, P.comp(column, listed))[1] == [0, 1, 2, 4]
    assert _extracted(spark, recs, P.comp(column, P.negated(listed), comp_semantics="all"))[1] == [2]
    assert _extracted(spark, recs, column, P.negated(P.comp(has_x, listed, comp_semantics="all")))[1] == [2]
    assert [P.is_late(f) for f in (column, has_x, P.negated(has_x), P.comp(column, has_x), P.negated(column))] == \
        [False, True, True, True, False]


def test_record_filter_sees_repaired_records(spark):
    recs = [{"a": "old", "n": {"k": ["p", "q"]}}, {"a": "gone"}, {"a": ["gone", "old"], "n": [{"k": "q"}]}, {"n": 1}]
    seen = P.record_filter(lambda r: r.get("a") in ("new", ["new"], None) and r.get("n") in ({"k": ["p"]}, [{"k": None}], None, 1))
    out, ids = _extracted(spark, recs, seen, dropped_values={"a": {"gone"}, "n.k": {"q"}}, remapped_values={"a": {"old": "new"}})
    assert ids == [0, 1, 2, 3]
    assert _extracted(spark, recs, P.record_filter(lambda r: "n" in r))[1] == [0, 2, 3]


def test_errors_in_python_filters_fail_the_job(spark):
    import pytest

    with pytest.raises(Exception, match="ZeroDivisionError"):
        _extracted(spark, [{"a": 0}], P.python_predicate(lambda x: 1 / x > 0, "a"))


def test_python_filters_walk_once(spark):
    column = P.get_filter_with_basic_predicate(P.eq("x"), "a")
    out, _ = _extracted(spark, [{"a": "x"}], column, P.python_predicate(lambda v: True, "a"), P.python_filter(lambda a: True, ["a"]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("try_variant_get") == plan.split("Generate explode")[1].count("try_variant_get")
    above = plan.split("Generate explode")[0]
    assert "ArrowEvalPython" in above and "try_variant_get" not in above
