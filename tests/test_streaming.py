"""The record extraction plan on a stream of JSON-lines files."""

from pyspark.sql import functions as F

from corpuskit.fields import Fields
from corpuskit.functions import predicates as P
from corpuskit.functions.paths import t_string
from corpuskit.session import staging_path
from corpuskit.sources import fixtures as FX
from corpuskit.streaming import extract_stream, stream_records, write_stream


def test_stream_extract_equals_batch(spark, sf):
    src = FX.rec_docs_file(spark, sf)
    recs = stream_records(spark, src)
    out = extract_stream(recs, {"id": Fields.ID.value}, filters=[P.catalogue_filter])
    target = staging_path(spark, "stream-out", unique=True)
    q = write_stream(out, target, target + "-ckpt")
    q.awaitTermination(300)
    got = {r.id for r in spark.read.parquet(target).select(t_string(F.col("id")).alias("id")).collect()}
    from corpuskit.plans.q_records import _ids

    expect = {r.id for r in _ids(spark, sf, P.catalogue_filter).collect()}
    assert got == expect and got
