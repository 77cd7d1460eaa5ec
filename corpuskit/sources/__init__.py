"""Scans and sinks: JSON-lines records, staged vocabularies, published CSV."""
