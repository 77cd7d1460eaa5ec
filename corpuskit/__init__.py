"""corpuskit: metadata-corpus preparation as Spark DataFrame operators."""

from corpuskit.session import checkpoint_root, get_spark, staging_path

__all__ = ["get_spark", "checkpoint_root", "staging_path"]
