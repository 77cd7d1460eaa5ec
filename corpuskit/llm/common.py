"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.session import materialize, path_exists

#: 13 hex digits of an md5 are 52 bits, which a double holds exactly.
HASH_SPAN = float(1 << 52)
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hash52(*parts: Column) -> Column:
    """A 52-bit integer (as a double) from the md5 of the parts joined by ``:``; null is ``~``."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")


def unit(*parts: Column) -> Column:
    """A hash draw strictly inside (0, 1)."""
    return (hash52(*parts) + F.lit(0.5)) / F.lit(HASH_SPAN)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, a lost executor costs nothing."""
    return materialize(df, f"llm-{name}")


def drop_written(*frames: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/llm-" in path and path_exists(spark, path):
                jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` holds about ``limit`` bytes in each piece (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    edge = np.cumsum(np.asarray(size, dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        done = edge[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(edge, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def blobs(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(col.cast(pa.binary()), b"").to_pylist()


def within(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than it must."""
    return df.limit(rows + 1).count() <= rows


def give_back() -> None:
    """Return a worker's free memory to the system: workers live on after a task, beside the next stage's."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it has
        pass
