"""The entry module: missing packages, and Python workers that see no folder of the driver."""

import os
import subprocess
import sys

import pytest

from corpuskit import fields as FD
from corpuskit.operators.vocab import registry_labels, staged_path
from corpuskit.plans import jobs as J
from corpuskit.session import staging_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOAD = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {ROOT!r} + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
"""


def _run(code, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()


def test_queries_stand_where_a_package_is_missing(tmp_path):
    code = "import sys\nsys.modules['public_tokenizers'] = None\n" + LOAD + "print(len(entry.queries()), any(n.startswith('op') for n in entry.queries()))"
    n, corpus = _run(code, tmp_path)
    assert int(n) > 100 and corpus == "False"


def test_workers_get_the_package(tmp_path, sf):
    code = LOAD + f"""
from corpuskit.session import get_spark
spark = get_spark("local[2]", 2, extra={{"spark.checkpoint.dir": {str(tmp_path / "ckpt")!r}, "spark.sql.warehouse.dir": {str(tmp_path / "wh")!r}}})
sys.path.remove({ROOT!r})
print("rows", entry.queries()["f_udf"](spark, {sf!r}).count())
"""
    assert int(_run(code, tmp_path)[-1]) > 0


def test_a_cluster_without_shared_folder_is_an_error():
    from corpuskit.session import checkpoint_root

    class Fake:
        master = "spark://host:7077"

        class _jsc:
            sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("D", (), {"isDefined": staticmethod(lambda: False)}))}))

    class Session:
        sparkContext = Fake

        class conf:
            get = staticmethod(lambda key, default=None: "file:/tmp/warehouse" if "warehouse" in key else default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_registry_defaults_and_overrides(spark):
    root = staging_path(spark, "voc-test", unique=True)
    write = lambda path, text: spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    known = FD.default_vocabularies()
    taxon, topic = FD.Fields.TAXONID.value, FD.Fields.TOPIC.value
    tree = '{"id": "s", "hasTopConcept": [{"id": "%s", "prefLabel": {"de": "%s"}}]}'
    write(staged_path(root, known[taxon]), tree % ("a", "A"))
    write(staged_path(root, known[topic]), tree % ("a", "other"))
    write(root + "/own", tree % ("a", "mine"))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(J.vocabulary_labels(spark, root, [taxon, topic])) == [(topic, "a", "other"), (taxon, "a", "A")]
    assert rows(J.vocabulary_labels(spark, root, [taxon, topic], overrides={taxon: root + "/own", topic: None})) == [(taxon, "a", "mine")]
    assert rows(registry_labels(spark, {"x": known[taxon]}, root)) == [("x", "a", "A")]
    assert rows(J.vocabulary_labels(spark, root, [])) == []
    assert set(known) == {FD.Fields[f].value for f in "EDUCATIONAL_CONTEXT FSK_RATING INTENDED_ENDUSER LRT TAXONID TOPIC".split()}


def test_review_session_names_similar_fields(spark):
    from conftest import records

    df = records(spark, [{"properties": {"title": "x", "topic": ["t"]}}] * 3)
    with pytest.raises(ValueError, match="properties.topic"):
        J.review_session(df, "rid", "properties.topics", spark.createDataFrame([], "uri string, label string"), "unused", 3, rate=1.0)
