"""Streaming record extraction (A1-A5 and C/D on ``readStream``)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit import fields as FD
from corpuskit.functions.predicates import Filter
from corpuskit.sources.records import extract_table, reroot


def stream_records(spark: SparkSession, path: str, prefix: str | None = FD.DEFAULT_PREFIX,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files arriving in ``path`` -> streaming ``v VARIANT`` records."""
    reader = (spark.readStream.schema("v variant").option("singleVariantColumn", "v")
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    return reroot(df, prefix) if prefix else df


def extract_stream(records: DataFrame, columns: Iterable[str] | Mapping[str, str],
                   filters: Iterable[Filter] = (), dropped_values: dict | None = None,
                   remapped_values: dict | None = None) -> DataFrame:
    """The batch extraction plan applied to a stream (no cap: a stream has no end)."""
    out = extract_table(records, columns, filters=filters, dropped_values=dropped_values,
                        remapped_values=remapped_values)
    return out.withColumn("ingested_at", F.current_timestamp())


def write_stream(extracted: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append to a parquet table; ``available_now`` processes what is there and stops."""
    writer = (extracted.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
