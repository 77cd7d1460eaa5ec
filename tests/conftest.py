import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpuskit.session import get_spark

    folder = tempfile.mkdtemp(prefix="corpuskit-test-")  # one machine: local mode shares it
    yield get_spark("local[4]", 4, extra={"spark.checkpoint.dir": folder + "/checkpoints",
                                          "spark.sql.warehouse.dir": folder + "/warehouse"})


@pytest.fixture(scope="session")
def sf():
    return SF


def records(spark, rows):
    """DataFrame(v VARIANT) from Python dicts (JSON round trip, like a JSON-lines scan)."""
    import json

    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "rid long, j string")
    return df.select("rid", F.parse_json("j").alias("v"))
