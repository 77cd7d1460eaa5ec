"""Loads every module that registers a query of the corpus operators."""

from corpuskit.llm import q_duplicates, q_mining, q_native, q_quality, q_text  # noqa: F401
from corpuskit.llm.registry import ORACLES, QUERIES  # noqa: F401
