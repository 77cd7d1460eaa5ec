"""The joint classification report: against its parts, and its plan."""

import random

from pyspark.sql import functions as F

from corpuskit.operators import report as R


def _data(spark, seed=0):
    rng = random.Random(seed)
    ids = [f"d{i}" for i in range(60)]
    pick = lambda p: [(d, c) for d in ids for c in ("a", "b", "c", "micro avg") if rng.random() < p]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id string, label string")
    return frame(pick(0.4) + [("elsewhere", "a")]), frame(pick(0.3) + [("d1", "only predicted")]), frame([(d, "") for d in ids]).select("doc_id")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_joint_report_equals_its_parts(spark):
    truth, pred, docs = _data(spark)
    for classes in (None, spark.createDataFrame([("a",), ("b",), ("never",)], "label string")):
        parts = R.per_class(truth, pred, classes).withColumnRenamed("label", "avg")
        for part in (R.micro_avg(truth, pred), R.macro_weighted_avg(truth, pred, classes), R.samples_avg(truth, pred, docs)):
            parts = parts.unionByName(part)
        assert _rows(R.classification_report(truth, pred, docs, classes)) == _rows(parts)


def test_joint_report_joins_once(spark):
    truth, pred, docs = _data(spark)
    plan = R.classification_report(truth, pred, docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Expand ") == 1


def test_empty_report(spark):
    truth, pred, docs = (x.limit(0) for x in _data(spark))
    got = {r["avg"]: r["support"] for r in R.classification_report(truth, pred, docs).collect()}
    assert set(got) <= {"micro avg"}
