"""Driver queries for scans, paths, filters and repair (A, B, C, D)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from corpuskit.fields import Fields, LANGUAGE_REMAPPED, PROTOCOL_FIELD
from corpuskit.functions import predicates as P
from corpuskit.functions.paths import get_in, leaf_paths, sampled_leaf_paths, t_first_string, t_is_list, t_scalar, \
    t_string, t_strings, t_vals, terminal
from corpuskit.functions.variant import as_array, is_string, vstr
from corpuskit.plans.oracle_views import CATALOGUE, HAS_TEXT, PUBLIC, REC, with_
from corpuskit.plans.registry import query
from corpuskit.sources import fixtures as FX
from corpuskit.sources.records import extract_table, read_records, records_count_frame

ID = Fields.ID.value
TAXON = Fields.TAXONID.value
LANG = Fields.LANGUAGE.value
W = with_(REC)


def _joined(t, sep="|"):
    return F.array_join(t_strings(t), sep, "<null>")


def _ids(spark, sf, *filters, **kw):
    out = extract_table(FX.rec_docs(spark, sf), {"__id": ID}, filters=list(filters), **kw)
    return out.select(t_string(F.col("__id")).alias("id"))


# --- A: scans ------------------------------------------------------------------

@query("scan_records", W + "SELECT id, typ AS type FROM rec")
def scan_records(spark, sf):
    recs = read_records(spark, FX.rec_docs_file(spark, sf), prefix=None)
    return recs.select(F.try_variant_get(get_in(F.col("v"), "_source.nodeRef.id"), "$", "string")
                       .alias("id"),
                       F.try_variant_get(get_in(F.col("v"), "_source.type"), "$", "string").alias("type"))


@query("scan_prefix", W + "SELECT id, title FROM rec")
def scan_prefix(spark, sf):
    recs = read_records(spark, FX.rec_docs_file(spark, sf), prefix="_source")
    t = extract_table(recs, {"id": ID, "title": Fields.TITLE.value})
    return t.select(t_string(F.col("id")).alias("id"), t_string(F.col("title")).alias("title"))


@query("scan_cap", W + f"SELECT id FROM (SELECT * FROM rec ORDER BY d LIMIT 100) WHERE {CATALOGUE}")
def scan_cap(spark, sf):
    recs = read_records(spark, FX.rec_docs_file(spark, sf))
    order = [F.try_variant_get(F.col("v"), "$.nodeRef.id", "string").cast("long")]
    t = extract_table(recs, {"id": ID}, filters=[P.catalogue_filter], max_len=100, order=order)
    return t.select(t_string(F.col("id")).alias("id"))


@query("num_records", "SELECT count(*) AS n FROM documents")
def num_records(spark, sf):
    return records_count_frame(spark, FX.rec_docs_file(spark, sf))


@query("extract_table", W + f"""
SELECT id, lang_list AS lang_is_list,
       CASE WHEN lang_two THEN lang || '|en' ELSE lang END AS lang_vals, title
FROM rec WHERE {CATALOGUE} AND {PUBLIC}""")
def extract_table_q(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "lang": LANG, "title": Fields.TITLE.value},
                      filters=[P.catalogue_filter, P.public_filter],
                      remapped_values={LANG: LANGUAGE_REMAPPED})
    return t.select(t_string(F.col("id")).alias("id"), t_is_list(F.col("lang")).alias("lang_is_list"),
                    _joined(F.col("lang")).alias("lang_vals"), t_string(F.col("title")).alias("title"))


# --- B: paths ------------------------------------------------------------------

@query("path_get", W + """
SELECT id, true AS is_list, CAST(CASE WHEN coll_two THEN 3 ELSE 2 END AS BIGINT) AS n_vals,
       CAST(1 AS BIGINT) AS n_null,
       CASE WHEN coll_two THEN coll_title || '|' || lang ELSE coll_title END AS titles
FROM rec""")
def path_get(spark, sf):
    r = FX.rec_docs(spark, sf)
    t = terminal(F.col("v"), Fields.COLLECTIONS_TITLE.value)
    return r.select(t_string(terminal(F.col("v"), ID)).alias("id"), t_is_list(t).alias("is_list"),
                    F.size(t_vals(t)).cast("long").alias("n_vals"),
                    F.size(F.filter(t_vals(t), lambda x: x.isNull())).cast("long").alias("n_null"),
                    F.array_join(t_strings(t), "|").alias("titles"))


@query("path_get_in", W + """
SELECT id, CAST(CASE WHEN coll_two THEN 3 ELSE 2 END AS BIGINT) AS n_vals, CAST(1 AS BIGINT) AS n_null,
       CASE WHEN coll_two THEN coll_title || '|' || lang ELSE coll_title END AS titles
FROM rec""")
def path_get_in(spark, sf):
    """B1: the sub-tree below a list, one value per element; strict where the path is in every record."""
    r = FX.rec_docs(spark, sf)
    vals = as_array(get_in(F.col("v"), Fields.COLLECTIONS_TITLE.value))
    return r.select(vstr(get_in(F.col("v"), ID, strict=True)).alias("id"), F.size(vals).cast("long").alias("n_vals"),
                    F.size(F.filter(vals, lambda x: x.isNull() | F.is_variant_null(x))).cast("long").alias("n_null"),
                    F.array_join(F.transform(vals, vstr), "|").alias("titles"))


@query("path_terminal", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, false AS is_list FROM events""")
def path_terminal(spark, sf):
    ev = FX.rec_events(spark, sf)
    t = terminal(F.col("v"), "props.k")
    return ev.select("event_id", F.try_variant_get(t_scalar(t), "$", "bigint").alias("k"),
                     t_is_list(t).alias("is_list"))


@query("path_flatten", """
SELECT conv_id, count(*) AS n_turns, count(*) AS n_null,
       CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS n_user,
       string_agg(role, ',' ORDER BY turn) AS roles
FROM conversations GROUP BY conv_id""")
def path_flatten(spark, sf):
    c = FX.rec_conv(spark, sf)
    turns = terminal(F.col("v"), "turns")
    roles = terminal(F.col("v"), "turns.role")
    return c.select("conv_id", F.size(t_vals(turns)).cast("long").alias("n_turns"),
                    F.size(F.filter(t_vals(turns), lambda x: x.isNull())).cast("long").alias("n_null"),
                    F.size(F.filter(t_strings(roles), lambda x: x == "user")).cast("long").alias("n_user"),
                    F.array_join(t_strings(roles), ",").alias("roles"))


def _leaves_of(json: str) -> str:
    """DuckDB: distinct leaf paths of the JSON documents of a table ``json(j)``; members that are null are left out."""
    return rf"""
SELECT DISTINCT path, CAST(len(string_split(path, '.')) AS INTEGER) AS depth FROM (
  SELECT array_to_string(list_transform(regexp_extract_all(regexp_replace(t.fullkey, '\[\d+\]', '', 'g'), '\."[^"]*"|\.[^."]+'),
                                        lambda k: trim(k[2:], '"')), '.') AS path
  FROM ({json}) d, json_tree(d.j) t
  WHERE t.type NOT IN ('OBJECT', 'ARRAY') AND NOT (t.type = 'NULL' AND NOT regexp_matches(t.fullkey, '\]$')))"""


REC_JSON = """
SELECT json_object(
  'nodeRef', json_object('id', id, 'storeRef', json_object('protocol', proto)), 'type', typ,
  'aspects', CASE asp WHEN 1 THEN []::VARCHAR[] WHEN 2 THEN ['ccm:collection'] END,
  'properties', json_object('cclom:title', title,
    'cclom:general_description', CASE WHEN has_descr THEN ['text'] ELSE []::VARCHAR[] END,
    'cclom:general_language', CASE WHEN lang_two THEN json_array(lang_code, 'en') WHEN lang_list THEN json_array(lang_code) ELSE to_json(lang_code) END,
    'cm:edu_metadataset', mds, 'ccm:taxonid', taxon,
    'ccm:oeh_ai_test_data', CASE WHEN in_test THEN ['properties.ccm:taxonid'] END, 'quality', quality),
  'permissions', json_object('Read', ['x']),
  'collections', CASE WHEN coll_two
    THEN json_array('c', json_object('permissions', json_object('Read', ['x']), 'properties', json_object('cm:title', coll_title, 'sys:node-uuid', id)),
                    json_object('properties', json_object('cm:title', lang, 'sys:node-uuid', lang)))
    ELSE json_array('c', json_object('permissions', json_object('Read', ['x']), 'properties', json_object('cm:title', coll_title, 'sys:node-uuid', id))) END) AS j
FROM rec"""


@query("leaf_paths", W + _leaves_of(REC_JSON))
def leaf_paths_q(spark, sf):
    return leaf_paths(FX.rec_docs(spark, sf))


@query("discover_fields", _leaves_of("""
SELECT json_object('event_id', event_id, 'event_type', event_type, 'props', props::JSON) AS j
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events) WHERE place % 10 = 0"""))
def discover_fields(spark, sf, rate: float = 0.1):
    """Leaf paths of every tenth record, shortest first."""
    return sampled_leaf_paths(FX.rec_events(spark, sf), rate, "event_id").orderBy(F.length("path"), "path")


@query("project_alias", W + "SELECT id AS doc, proto, CAST(len(taxon) AS BIGINT) AS n_taxa FROM rec")
def project_alias(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"doc": ID, "proto": PROTOCOL_FIELD, "n_taxa": TAXON})
    return t.select(t_string(F.col("doc")).alias("doc"), t_string(F.col("proto")).alias("proto"),
                    F.size(t_vals(F.col("n_taxa"))).cast("long").alias("n_taxa"))


@query("unnest_first", W + """
SELECT id, CASE WHEN has_descr THEN md5(text) END AS descr_md5,
       CAST(CASE WHEN has_descr THEN length(text) END AS BIGINT) AS descr_len FROM rec""")
def unnest_first(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "descr": Fields.DESCRIPTION.value})
    descr = t_first_string(F.col("descr"))
    return t.select(t_string(F.col("id")).alias("id"), F.md5(descr).alias("descr_md5"),
                    F.length(descr).cast("long").alias("descr_len"))


@query("assemble_text", W + """
SELECT id, md5(coalesce(title, '') || chr(10) || CASE WHEN has_descr THEN text ELSE '' END) AS text_md5,
       CAST(length(coalesce(title, '') || chr(10) || CASE WHEN has_descr THEN text ELSE '' END) AS BIGINT)
         AS text_len
FROM rec""")
def assemble_text(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "title": Fields.TITLE.value,
                                                "descr": Fields.DESCRIPTION.value})
    text = F.concat(F.coalesce(t_string(F.col("title")), F.lit("")), F.lit("\n"),
                    F.coalesce(t_first_string(F.col("descr")), F.lit("")))
    return t.select(t_string(F.col("id")).alias("id"), F.md5(text).alias("text_md5"),
                    F.length(text).cast("long").alias("text_len"))


@query("editor_flag", W + "SELECT id, coll_title = 'Redaktionsbuffet' AS editor FROM rec")
def editor_flag(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "ct": Fields.COLLECTIONS_TITLE.value})
    ed = F.coalesce(F.exists(t_vals(F.col("ct")), lambda x: is_string(x) & (vstr(x) == "Redaktionsbuffet")),
                    F.lit(False))
    return t.select(t_string(F.col("id")).alias("id"), ed.alias("editor"))


@query("test_flag", W + "SELECT id, in_test FROM rec")
def test_flag(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "td": Fields.TEST_DATA.value})
    flag = F.coalesce(F.exists(t_vals(F.col("td")), lambda x: is_string(x) & (vstr(x) == TAXON)),
                      F.lit(False))
    return t.select(t_string(F.col("id")).alias("id"), flag.alias("in_test"))


# --- C: filters ----------------------------------------------------------------

def _starts_de(x):
    return is_string(x) & vstr(x).startswith("de")


def _size_at_least_2(t):
    return F.size(t_vals(t)) >= 2


FILTER_QUERIES = {
    "f_negated": (lambda: P.negated(P.catalogue_filter), f"NOT {CATALOGUE}"),
    "f_comp_any": (lambda: P.comp(P.catalogue_filter, P.public_filter), f"{CATALOGUE} OR {PUBLIC}"),
    "f_comp_all": (lambda: P.comp(P.catalogue_filter, P.public_filter, comp_semantics="all"),
                   f"{CATALOGUE} AND {PUBLIC}"),
    "f_lift_any": (lambda: P.get_filter(P.lift(_starts_de, "any"), LANG), "lang_code LIKE 'de%'"),
    "f_lift_all": (lambda: P.get_filter(P.lift(P.ne("en"), "all"), LANG),
                   "lang_code <> 'en' AND NOT lang_two"),
    "f_path": (lambda: P.get_filter(_size_at_least_2, TAXON), "len(taxon) >= 2"),
    "f_basic_pred": (lambda: P.get_filter_with_basic_predicate(P.eq("workspace"), PROTOCOL_FIELD),
                     "proto = 'workspace'"),
    "f_catalogue": (lambda: P.catalogue_filter, CATALOGUE),
    "f_public": (lambda: P.public_filter, PUBLIC),
    "f_editor": (lambda: P.editor_filter, "coll_title = 'Redaktionsbuffet'"),
    "f_collections": (lambda: P.collections_filter, "asp = 2"),
    "f_test_labels": (lambda: P.test_data_filter([TAXON]), "in_test"),
    "f_language": (lambda: P.language_filter(["de", "en"]), "lang_code IN ('de', 'en')"),
    "f_german": (lambda: P.german_filter, "lang_code IN ('de', 'de_DE', 'de-DE') AND NOT lang_two"),
    "f_labeled_any": (lambda: P.labeled_filter([Fields.TEST_DATA.value, "properties.quality"]),
                      "in_test OR coalesce(quality = 1, false)"),
    "f_labeled_all": (lambda: P.labeled_filter([Fields.TEST_DATA.value, "properties.quality"],
                                               multi_field_semantics="all"),
                      "in_test AND coalesce(quality = 1, false)"),
    "f_len_any": (lambda: P.len_filter([Fields.TITLE.value, Fields.DESCRIPTION.value], 30),
                  "coalesce(length(title), 0) >= 30"),
    "f_len_all": (lambda: P.len_filter([Fields.TITLE.value, LANG], 2, multi_field_semantics="all"),
                  "coalesce(length(title), 0) >= 2 AND (NOT lang_list OR lang_two)"),
    "f_len_per_field": (lambda: P.len_filter([Fields.TITLE.value, LANG], [40, 2]),
                        "coalesce(length(title), 0) >= 40 OR NOT lang_list OR lang_two"),
    "f_has_text": (lambda: P.existing_text_filter, HAS_TEXT),
}


# the same conditions in Python: on single values, on values of several paths, on whole records
PYTHON_FILTER_QUERIES = {
    "f_udf": (lambda: [P.catalogue_filter, P.comp(P.public_filter, P.python_predicate(
        lambda x: isinstance(x, str) and x.startswith("de"), LANG))],
              f"{CATALOGUE} AND ({PUBLIC} OR lang_code LIKE 'de%')"),
    "f_udf_fields": (lambda: [P.negated(P.python_filter(
        lambda title, taxa: title is None or len(taxa) > 1, [Fields.TITLE.value, TAXON]))],
                     "title IS NOT NULL AND len(taxon) <= 1"),
    "f_udf_record": (lambda: [P.negated(P.editor_filter), P.record_filter(
        lambda r: len(r["properties"].get("cclom:general_description") or []) > 0 and r["type"] == "ccm:io")],
                     "coll_title <> 'Redaktionsbuffet' AND has_descr AND typ = 'ccm:io'"),
    "f_udf_pandas": (lambda: [P.udf_filter(lambda r: _title_longer(t_string(r.terminal(Fields.TITLE.value)), F.lit(20)))],
                     "coalesce(length(title), 0) > 20"),
}


@F.pandas_udf(BooleanType())
def _title_longer(title: pd.Series, n: pd.Series) -> pd.Series:
    return title.str.len().fillna(0) > n


for _name, (_make, _cond) in PYTHON_FILTER_QUERIES.items():
    def _run(spark, sf, make=_make):
        return _ids(spark, sf, *make())
    query(_name, W + f"SELECT id FROM rec WHERE {_cond}")(_run)


def _register_filter(name, make, cond):
    @query(name, W + f"SELECT id FROM rec WHERE {cond}")
    def run(spark, sf):
        return _ids(spark, sf, make())
    run.__name__ = name
    return run


for _name, (_make, _cond) in FILTER_QUERIES.items():
    _register_filter(_name, _make, _cond)


# --- D: repair -----------------------------------------------------------------

SRC1 = "http://x/t/src1"
SRCX = "http://x/t/srcX"
_TAXON_REPAIRED = ("array_to_string(list_transform(list_filter(taxon, lambda x: x IS NULL OR x <> ''), "
                   f"lambda x: CASE WHEN x = '{SRC1}' THEN '{SRCX}' ELSE coalesce(x, '<null>') END), '|')")
_TAXON_NO_EMPTY = ("array_to_string(list_transform(list_filter(taxon, lambda x: x IS NULL OR x <> ''), "
                   "lambda x: coalesce(x, '<null>')), '|')")


@query("repair_path", W + f"""
SELECT id, CAST(len(list_filter(taxon, lambda x: x IS NULL OR x <> '')) AS BIGINT) AS n_vals,
       {_TAXON_REPAIRED} AS vals FROM rec""")
def repair_path(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "tx": TAXON},
                      dropped_values={TAXON: {""}}, remapped_values={TAXON: {SRC1: SRCX}})
    return t.select(t_string(F.col("id")).alias("id"), F.size(t_vals(F.col("tx"))).cast("long")
                    .alias("n_vals"), _joined(F.col("tx")).alias("vals"))


@query("repair_scalar", W + """
SELECT id, CASE WHEN lang = 'es' THEN NULL ELSE lang END AS lang FROM rec WHERE NOT lang_list""")
def repair_scalar(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "lang": LANG}, dropped_values={LANG: {"es"}},
                      remapped_values={LANG: LANGUAGE_REMAPPED}).where(~t_is_list(F.col("lang")))
    return t.select(t_string(F.col("id")).alias("id"), t_string(F.col("lang")).alias("lang"))


@query("repair_list", W + """
SELECT id, CAST(len(l) AS BIGINT) AS n_vals, array_to_string(l, '|') AS vals
FROM (SELECT id, list_filter(CASE WHEN lang_two THEN [lang, 'en'] ELSE [lang] END, lambda x: x <> 'es') AS l
      FROM rec WHERE lang_list)""")
def repair_list(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "lang": LANG}, dropped_values={LANG: {"es"}},
                      remapped_values={LANG: LANGUAGE_REMAPPED}).where(t_is_list(F.col("lang")))
    return t.select(t_string(F.col("id")).alias("id"), F.size(t_vals(F.col("lang"))).cast("long")
                    .alias("n_vals"), _joined(F.col("lang")).alias("vals"))


@query("repair_values", W + """
SELECT id, lang_list AS is_list, array_to_string(list_transform(l, lambda x: coalesce(x, '<null>')), '|') AS vals
FROM (SELECT id, lang_list, CASE WHEN NOT lang_list THEN [nullif(lang, 'es')]
             ELSE list_filter(CASE WHEN lang_two THEN [lang, 'en'] ELSE [lang] END, lambda x: x <> 'es') END AS l FROM rec)""")
def repair_values(spark, sf):
    """D1, D2 over all records: scalars are remapped or nulled, lists are remapped and lose what is dropped."""
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "lang": LANG}, dropped_values={LANG: {"es"}},
                      remapped_values={LANG: LANGUAGE_REMAPPED})
    return t.select(t_string(F.col("id")).alias("id"), t_is_list(F.col("lang")).alias("is_list"), _joined(F.col("lang")).alias("vals"))


@query("repair_nested", """
SELECT conv_id, count(*) AS n_vals,
       string_agg(CASE role WHEN 'system' THEN '<null>' WHEN 'assistant' THEN 'bot' ELSE role END, '|'
                  ORDER BY turn) AS roles
FROM conversations GROUP BY conv_id""")
def repair_nested(spark, sf):
    c = FX.rec_conv(spark, sf)
    t = extract_table(c, {"roles": "turns.role"}, dropped_values={"turns.role": {"system"}},
                      remapped_values={"turns.role": {"assistant": "bot"}}, keep=["conv_id"])
    return t.select("conv_id", F.size(t_vals(F.col("roles"))).cast("long").alias("n_vals"),
                    _joined(F.col("roles")).alias("roles"))


@query("repair_multi", W + f"""
SELECT id, {_TAXON_REPAIRED} AS taxa, CASE WHEN lang_two THEN lang || '|en' ELSE lang END AS langs
FROM rec""")
def repair_multi(spark, sf):
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "tx": TAXON, "lang": LANG},
                      dropped_values={TAXON: {""}},
                      remapped_values={TAXON: {SRC1: SRCX}, LANG: LANGUAGE_REMAPPED})
    return t.select(t_string(F.col("id")).alias("id"), _joined(F.col("tx")).alias("taxa"),
                    _joined(F.col("lang")).alias("langs"))


@query("repair_defaults", W + f"""
SELECT id, {_TAXON_NO_EMPTY} AS taxa,
       CASE WHEN lang_code = 'en_US' THEN 'english' ELSE lang_code END
         || CASE WHEN lang_two THEN '|en' ELSE '' END AS langs
FROM rec""")
def repair_defaults(spark, sf):
    from corpuskit import fields as FD

    dropped = FD.merge_defaults(FD.default_dropped_values(), {})
    remapped = FD.merge_defaults(FD.default_remapped_values(), {LANG: {"en_US": "english"}})
    t = extract_table(FX.rec_docs(spark, sf), {"id": ID, "tx": TAXON, "lang": LANG},
                      dropped_values=dropped, remapped_values=remapped)
    return t.select(t_string(F.col("id")).alias("id"), _joined(F.col("tx")).alias("taxa"),
                    _joined(F.col("lang")).alias("langs"))
