"""Queries that encode texts: SentencePiece pieces, binary token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from corpuskit.llm.common import table
from corpuskit.llm.registry import query
from corpuskit.llm.sentence_pieces import encode_documents
from corpuskit.llm.token_files import read_tokens, write_tokens
from corpuskit.session import staging_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


@query("op7_sentence_pieces")
def op7_sentence_pieces(spark, sf_dir):
    """Per document: pieces, crc32 of the ids, crc32 of the text that they decode to, and whether it is the text."""
    done = encode_documents(table(spark, sf_dir, "documents"), PIECES, ids=False, back=True)
    return done.select("doc_id", "n_pieces", "ids_crc32",
                       F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"), "round_trip")


@query("op2_range_coder")
def op2_range_coder(spark, sf_dir):
    """Every document's place among all ids, number of ids and their crc32, read back from the coded files."""
    path = staging_path(spark, "tables", "llm-tokens", unique=True)
    write_tokens(table(spark, sf_dir, "documents"), path, BYTE_BPE, END_ID)
    return read_tokens(spark, path)
