"""Joins on words, kept clear of the few most frequent ones.

A share of all tokens belongs to a few words. Their keys come to the driver (a bounded list),
and rows of these words are judged where they are, by a set lookup in the row; only rows of the
other words are shuffled to the table that they are held against. A table of a bounded number of
words goes to all tasks, and no row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.session import materialize

#: Words that are judged inside rows, at most.
HOT_WORDS = 256
#: Words of a table that goes to all tasks, at most.
SMALL_WORDS = 500_000


def hot_words(counts: DataFrame, n: str, word: str = "word", most: int = HOT_WORDS) -> list[str]:
    """The ``most`` words of ``counts(word, n)`` with the largest counts."""
    rows = counts.where(F.col(word).isNotNull()).orderBy(F.desc(n), F.asc(word)).limit(most).select(word).collect()
    return [r[0] for r in rows]


def among(c: Column, words: list[str]) -> Column:
    """Whether ``c`` is one of ``words``; never NULL."""
    return F.coalesce(c.isin(*words), F.lit(False)) if words else F.lit(False)


def hot_in(words: DataFrame, hot: list[str], word: str = "word") -> list[str]:
    """The hot words that are in the table ``words``."""
    return [r[0] for r in words.where(among(F.col(word), hot)).select(word).distinct().collect()] if hot else []


def _written(words: DataFrame, word: str) -> tuple[DataFrame, bool]:
    """The distinct words, written once since they are read more than once, and whether they go to all tasks."""
    own = materialize(words.select(word).distinct(), "words")
    return own, own.count() <= SMALL_WORDS


def keep_words(rows: DataFrame, words: DataFrame, hot: list[str], word: str = "word", keep: bool = True,
               others: DataFrame | None = None) -> DataFrame:
    """Rows whose word is in the table ``words`` (``keep``), or is not.

    ``others`` has the words of the rows that are not in ``words``, where the caller knows them; it is used if it alone is small.
    """
    own, small = _written(words, word)
    if not small and others is not None:
        rest, rest_small = _written(others, word)
        if rest_small:
            found = rows.join(F.broadcast(rest), word, "left_anti" if keep else "left_semi").select(*rows.columns)
            return found.where(F.col(word).isNotNull()) if keep else found.unionByName(rows.where(F.col(word).isNull()))
    return _held(rows, own, small, hot, word, keep)


def _held(rows: DataFrame, own: DataFrame, small: bool, hot: list[str], word: str, keep: bool) -> DataFrame:
    how = "left_semi" if keep else "left_anti"
    if small:
        return rows.join(F.broadcast(own), word, how).select(*rows.columns)
    listed = hot_in(own, hot, word)
    stay = listed if keep else [w for w in hot if w not in set(listed)]
    # distinct words spread evenly, so a task's share of them makes a small hash table: no sort of the rows
    rare = rows.where(~among(F.col(word), hot)).join(own.hint("shuffle_hash"), word, how)
    rare = rare.select(*rows.columns)
    return rare.unionByName(rows.where(among(F.col(word), stay))) if stay else rare


def judge_tokens(docs: DataFrame, words: DataFrame, hot: list[str], col: str = "tokens", keep: bool = True) -> DataFrame:
    """``docs`` with the tokens that are in the table ``words`` (``keep``), or the others; order and repeats stay.

    Hot tokens are judged in their row. The others are held against ``words`` with their positions and
    merged back by document. A NULL list becomes empty. ``doc_id`` is the key of ``docs``.
    """
    words, small = _written(words, "word")
    listed = hot_in(words, hot)
    stay = listed if keep else [w for w in hot if w not in set(listed)]
    placed = F.transform(col, lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    rest = docs.select("doc_id", F.explode(F.filter(placed, lambda x: ~among(x["word"], hot))).alias("t")) \
        .select("doc_id", "t.pos", "t.word")
    kept = _held(rest, words, small, [], "word", keep).groupBy("doc_id").agg(
        F.collect_list(F.struct("pos", "word")).alias("__rare"))
    none = F.array().cast("array<struct<pos:int,word:string>>")
    own = docs.withColumn(col, F.filter(placed, lambda x: among(x["word"], stay)))
    merged = F.array_sort(F.concat(F.coalesce(F.col(col), none), F.coalesce("__rare", none)))
    return own.join(kept, "doc_id", "left").withColumn(col, F.transform(merged, lambda x: x["word"])) \
        .drop("__rare").select(*docs.columns)
