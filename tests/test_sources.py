"""Sources: gzip input, prefix errors, record count, evaluation registry."""

import pytest
from pyspark.sql import functions as F

from corpuskit.fields import Fields
from corpuskit.session import staging_path
from corpuskit.sources import fixtures as FX
from corpuskit.sources.records import count_records, read_records


def test_gzip_records_round_trip(spark, sf):
    path = staging_path(spark, "gz", unique=True)
    FX.rec_docs_json(spark, sf).select(F.col("json").alias("value")).coalesce(1) \
        .write.option("compression", "gzip").text(path)
    recs = read_records(spark, path, repartition=4)
    assert recs.rdd.getNumPartitions() == 4
    assert recs.count() == FX.table(spark, sf, "documents").count() == count_records(spark, path)


def test_missing_prefix_fails(spark):
    path = staging_path(spark, "bad-prefix", unique=True)
    spark.createDataFrame([('{"other": 1}',)], "value string").write.text(path)
    with pytest.raises(Exception):
        read_records(spark, path).collect()


def test_evaluation_registry():
    from corpuskit.operators.report import classification_report, evaluation_registry

    reg = evaluation_registry()
    assert len(reg) == 8 and reg[Fields.TAXONID.value] is classification_report


def test_vocabulary_of_one_document_per_file(spark):
    from corpuskit.operators.vocab import concept_nodes
    from corpuskit.sources.records import read_vocabulary

    path = staging_path(spark, "vocab", unique=True)
    text = '{\n "id": "top",\n "hasTopConcept": [\n  {"id": "a", "prefLabel": {"de": "A"},\n   "narrower": [{"id": "b"}]}\n ]\n}'
    for k in range(2):
        spark.createDataFrame([(text.replace("top", f"top{k}"),)], "value string").coalesce(1).write.mode("append").text(path)
    nodes = {(r.id, r.parent) for r in concept_nodes(read_vocabulary(spark, path)).collect()}
    assert nodes == {("top0", None), ("top1", None), ("a", "top0"), ("a", "top1"), ("b", "a")}


def test_review_lists_round_trip(spark):
    from corpuskit.plans.jobs import record_review
    from corpuskit.sources.records import read_id_list

    state = staging_path(spark, "lists", unique=True)
    assert read_id_list(spark, state + "/visited.csv").count() == 0
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "doc_id string")
    record_review(spark, state, ids("1", "2"), ids("2"))
    record_review(spark, state, ids("2", "3"), ids("3"))
    assert {r.doc_id for r in read_id_list(spark, state + "/visited.csv").collect()} == {"1", "2", "3"}
    assert {r.doc_id for r in read_id_list(spark, state + "/accepted.csv").collect()} == {"2", "3"}
