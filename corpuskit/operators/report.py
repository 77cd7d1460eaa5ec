"""Classification reports (J1-J7) as joins and aggregates.

Inputs are long tables ``truth(doc_id, label)`` and ``pred(doc_id, label)``
(multi-label) or one label per document (single-label). A metric whose
denominator is zero is 0. Ratios are rounded to 6 digits once, at output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _metrics(tp: Column, fp: Column, fn: Column) -> list[Column]:
    p = _ratio(tp.cast("double"), (tp + fp).cast("double"))
    r = _ratio(tp.cast("double"), (tp + fn).cast("double"))
    f1 = F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), f1.alias("f1")]


def _round(df: DataFrame, cols=("precision", "recall", "f1")) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, DIGITS))
    return df


def _outcomes(truth: DataFrame, pred: DataFrame) -> DataFrame:
    t = truth.select("doc_id", "label", F.lit(1).alias("t")).distinct()
    p = pred.select("doc_id", "label", F.lit(1).alias("p")).distinct()
    j = t.join(p, ["doc_id", "label"], "full_outer")
    return j.select("doc_id", "label",
                    (F.coalesce("t", F.lit(0)) * F.coalesce("p", F.lit(0))).alias("tp"),
                    ((1 - F.coalesce("t", F.lit(0))) * F.coalesce("p", F.lit(0))).alias("fp"),
                    (F.coalesce("t", F.lit(0)) * (1 - F.coalesce("p", F.lit(0)))).alias("fn"))


def per_class(truth: DataFrame, pred: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """``(label, precision, recall, f1, support)``; classes default to all labels seen."""
    return _round(_class_metrics(truth, pred, classes))


def _class_metrics(truth: DataFrame, pred: DataFrame, classes: DataFrame | None) -> DataFrame:
    """J1 before rounding: averages are taken from these."""
    o = _outcomes(truth, pred)
    agg = o.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                                 F.sum("fn").alias("fn"))
    if classes is not None:
        agg = classes.select("label").join(agg, "label", "left").na.fill(0, ["tp", "fp", "fn"])
    out = agg.select("label", *_metrics(F.col("tp"), F.col("fp"), F.col("fn")),
                     (F.col("tp") + F.col("fn")).cast("long").alias("support"))
    return out


def micro_avg(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """One row."""
    o = _outcomes(truth, pred).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                                   F.sum("fn").alias("fn"))
    return _round(o.select(F.lit("micro avg").alias("avg"),
                           *_metrics(F.col("tp"), F.col("fp"), F.col("fn")),
                           (F.col("tp") + F.col("fn")).cast("long").alias("support")))


def macro_weighted_avg(truth: DataFrame, pred: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Macro and support-weighted averages over all classes (two rows)."""
    return _averages(_class_metrics(truth, pred, classes))


def _averages(metrics: DataFrame) -> DataFrame:
    s = F.sum("support")
    macro = metrics.agg(F.lit("macro avg").alias("avg"), F.avg("precision").alias("precision"),
                        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                        s.cast("long").alias("support"))
    weighted = metrics.agg(
        F.lit("weighted avg").alias("avg"),
        *[_ratio(F.sum(F.col(m) * F.col("support")), s.cast("double")).alias(m)
          for m in ("precision", "recall", "f1")],
        s.cast("long").alias("support"))
    return _round(macro.unionByName(weighted))


def samples_avg(truth: DataFrame, pred: DataFrame, docs: DataFrame) -> DataFrame:
    """Per-document precision/recall/f1 averaged over all documents."""
    o = _outcomes(truth, pred).groupBy("doc_id").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                                                      F.sum("fn").alias("fn"))
    d = docs.select("doc_id").distinct().join(o, "doc_id", "left").na.fill(0, ["tp", "fp", "fn"])
    per_doc = d.select(*_metrics(F.col("tp"), F.col("fp"), F.col("fn")), F.col("tp") + F.col("fn"))
    per_doc = per_doc.toDF("precision", "recall", "f1", "support")
    out = per_doc.agg(F.lit("samples avg").alias("avg"), F.avg("precision").alias("precision"),
                      F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                      F.sum("support").cast("long").alias("support"))
    return _round(out)


def _single_label(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """``(doc_id, t, p)``; a document without a prediction has none, and so a wrong one."""
    return truth.select("doc_id", F.col("label").alias("t")).join(
        pred.select("doc_id", F.col("label").alias("p")), "doc_id", "left")


def _single_label_metrics(joined: DataFrame) -> DataFrame:
    labels = F.filter(F.array_distinct(F.array("t", "p")), lambda x: x.isNotNull())
    ex = joined.select("t", "p", F.explode(labels).alias("label"))
    is_t = F.coalesce(F.col("t") == F.col("label"), F.lit(False))
    is_p = F.coalesce(F.col("p") == F.col("label"), F.lit(False))
    per = ex.groupBy("label").agg(F.sum((is_t & is_p).cast("int")).alias("tp"),
                                  F.sum((~is_t & is_p).cast("int")).alias("fp"),
                                  F.sum((is_t & ~is_p).cast("int")).alias("fn"))
    return per.select("label", *_metrics(F.col("tp"), F.col("fp"), F.col("fn")),
                      (F.col("tp") + F.col("fn")).cast("long").alias("support"))


def multiclass_report(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """Single-label report: per-class rows plus ``accuracy`` in every row."""
    from corpuskit.operators.text import with_scalar

    j = _single_label(truth, pred)
    right = F.coalesce(F.col("t") == F.col("p"), F.lit(False)).cast("double")
    return _round(with_scalar(_single_label_metrics(j), j.agg(F.avg(right).alias("accuracy"))),
                  ("precision", "recall", "f1", "accuracy"))


def multiclass_averages(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """The macro and weighted rows of the single-label report."""
    return _averages(_single_label_metrics(_single_label(truth, pred)))


def named(report: DataFrame, names: DataFrame, label: str = "label") -> DataFrame:
    """Attach readable names ``names(label, name)`` to a report; rows without one keep NULL."""
    own = names.select(F.col("label").alias("__label"), "name")
    return report.join(own, report[label] == own["__label"], "left").drop("__label")


def classification_report(truth: DataFrame, pred: DataFrame, docs: DataFrame,
                          classes: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """Everything of the multi-label report in one frame: classes, then averages.

    ``classes(label)`` are all categories of the field, so that those without truth and
    prediction count in the averages; ``names`` adds a readable name to the class rows.

    Truth and prediction are joined once. One aggregate over grouping sets sums the outcomes by label, by
    document and over all; a second one turns class and document rows into averages.
    """
    out = _report_lines(_outcome_sums(truth, pred, docs, classes))
    return out if names is None else named(out, names, "avg")


def _outcome_sums(truth: DataFrame, pred: DataFrame, docs: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``(kind, label, tp, fp, fn)``: a row per class, per document and for all (kind ``class``, ``doc``, ``all``)."""
    zero = [F.lit(0).alias(c) for c in ("tp", "fp", "fn")]
    none = F.lit(None).cast("string")
    rows = _outcomes(truth, pred).withColumn("of", F.lit("pair"))
    rows = rows.unionByName(docs.select("doc_id", none.alias("label"), *zero, F.lit("doc").alias("of")).distinct())
    if classes is not None:
        rows = rows.unionByName(classes.select(none.alias("doc_id"), "label", *zero, F.lit("class").alias("of")))
    sums = rows.groupingSets([[F.col("label")], [F.col("doc_id")], []], F.col("label"), F.col("doc_id")).agg(
        F.grouping_id("label", "doc_id").alias("set"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
        *[F.max(F.col("of") == x).alias("has_" + x) for x in ("pair", "doc", "class")])
    # the sets' bits: 1 = grouped by label alone, 2 = by document alone, 3 = all
    kind = F.when(F.col("set") == 1, "class").when(F.col("set") == 2, "doc").otherwise("all")
    wanted = F.when(F.col("set") == 1, F.col("has_pair" if classes is None else "has_class") & F.col("label").isNotNull()) \
        .when(F.col("set") == 2, F.col("has_doc")).otherwise(F.lit(True))
    return sums.where(wanted).select(kind.alias("kind"), "label", "tp", "fp", "fn")


def _report_lines(sums: DataFrame) -> DataFrame:
    """``(avg, precision, recall, f1, support)`` from the sums of classes, documents and all."""
    m = sums.select("kind", "label", *_metrics(F.col("tp"), F.col("fp"), F.col("fn")),
                    (F.col("tp") + F.col("fn")).cast("long").alias("support"))
    lines = F.when(F.col("kind") == "class", F.array(F.concat(F.lit("="), "label"), F.lit("macro avg"), F.lit("weighted avg"))) \
        .when(F.col("kind") == "doc", F.array(F.lit("samples avg"))).otherwise(F.array(F.lit("micro avg")))
    line = F.col("line")
    agg = m.select("*", F.explode(lines).alias("line")).groupBy("line").agg(
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
        *[F.sum(F.col(c) * F.col("support")).alias("w_" + c) for c in ("precision", "recall", "f1")],
        F.sum("support").cast("long").alias("support"))
    weighted = line == "weighted avg"
    return _round(agg.select(
        F.when(line.startswith("="), F.substring(line, F.lit(2), F.length(line))).otherwise(line).alias("avg"),
        *[F.when(weighted, _ratio(F.col("w_" + c), F.col("support").cast("double"))).otherwise(F.col(c)).alias(c)
          for c in ("precision", "recall", "f1")], "support"))


# Field -> evaluation function (multi-label report for the default fields)
def evaluation_registry() -> dict:
    from corpuskit.fields import EVALUATED_FIELDS

    return {f.value: classification_report for f in EVALUATED_FIELDS}
