"""Corpus operators: encoding, subsetting, vocabularies, text, pruning, ordering,
splitting and evaluation. Every operator is lazy and returns DataFrames."""
