"""Structured Streaming form of the record operators.

Scans, path walks, repairs and filters are stateless per record, so the same
``extract_table`` plan runs on a ``readStream`` source. Incremental batches are
appended to a table in the shared folder; the checkpoint location makes the
stream restartable after a lost executor or driver.
"""

from corpuskit.streaming.records import extract_stream, stream_records, write_stream

__all__ = ["stream_records", "extract_stream", "write_stream"]
