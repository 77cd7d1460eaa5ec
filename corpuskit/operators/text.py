"""Tokens, token filters and bags of words.

Tokens are an ``ARRAY<STRING>`` column of ``docs``. The linguistic model of the
original (lemmas, tags, sentence splitter, language detector) is an external
per-row library; here tokenisation is a regular expression, the language is a
stop-word vote, tags are token classes, and each step accepts a caller-supplied
replacement: a Column function, or a column that a pandas UDF has filled.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.operators.corpus import Corpus, filter_tokens, subset_docs, token_words
from corpuskit.operators.hot import hot_words
from corpuskit.session import materialize

TOKEN_PATTERN = r"[\p{L}\p{N}]+"
SENTENCE_PATTERN = r"[.!?\n]+"

# --- fixed values: stop words for the language vote ---------------------------
STOPWORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "auf", "für", "sich"),
    "en": ("the", "and", "of", "is", "to", "in", "it", "that", "with", "for", "this", "are"),
    "es": ("el", "los", "las", "y", "que", "por", "con", "una", "para", "del", "es", "se"),
    "fr": ("le", "les", "et", "des", "est", "une", "pour", "dans", "qui", "du", "sur", "pas"),
}


def tokenise(docs: DataFrame, text_col: str = "raw_text", out: str = "tokens",
             pattern: str = TOKEN_PATTERN, tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """G1: ``tokens`` from the text (regex by default, or a caller's Column function /
    pandas UDF returning ``array<string>``)."""
    col = tokenizer(F.col(text_col)) if tokenizer else F.regexp_extract_all(
        F.col(text_col), F.lit(pattern), 0)
    return docs.withColumn(out, col)


def language_vote(docs: DataFrame, tokens_col: str = "tokens", out: str = "language",
                  stopwords: dict[str, Iterable[str]] = STOPWORDS) -> DataFrame:
    """language = the language whose stop words occur most (ties: smaller code);
    NULL when no stop word occurs. Counted inside each row, without a shuffle."""
    lower = F.transform(F.coalesce(F.col(tokens_col), F.array().cast("array<string>")), F.lower)

    def votes(words: Column) -> Column:
        def count(own: list[str]) -> Column:
            return F.size(F.filter(words, lambda w: w.isin(own)))

        # the least of the negated counts, then the smaller code
        return F.array_min(F.array(*[F.struct((-count(list(own))).alias("n"), F.lit(lang).alias("lang"))
                                     for lang, own in stopwords.items()]))

    best = F.get(F.transform(F.array(lower), votes), 0)
    return docs.withColumn(out, F.when(best["n"] < 0, best["lang"]))


def keep_language(corpus: Corpus, language: str = "de") -> Corpus:
    """Keep documents whose language is ``language``."""
    return subset_docs(corpus, corpus.docs.where(F.col("language") == language).select("doc_id"))


def repetition_filter(docs: DataFrame, min_rep_count: int = 3, post_filter_count: int = 1,
                      col: str = "tokens", key: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """Runs of at least ``min_rep_count`` identical tokens keep their first
    ``post_filter_count`` tokens. ``key`` gives the token of an element, for lists of tagged tokens.

    Inside each row: a run starts where a token differs from the one before; each run is
    sliced to its new length, and the slices are joined again.
    """
    if min_rep_count < 2:
        raise ValueError(f"a run has two tokens or more, got min_rep_count={min_rep_count}")
    if post_filter_count > min_rep_count:
        raise ValueError(f"cannot keep {post_filter_count} tokens of runs that may have {min_rep_count}")

    def shortened(words: Column) -> Column:
        n = F.size(words)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | ~key(F.get(words, i)).eqNullSafe(key(F.get(words, i - 1))))

        def cut(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), n), F.array(n))
            return F.flatten(F.zip_with(at, ends, lambda a, e: F.slice(
                words, a + 1, F.when(e - a >= min_rep_count, F.lit(post_filter_count)).otherwise(e - a))))

        return F.get(F.transform(F.array(starts), cut), 0)

    return docs.withColumn(col, F.when(F.size(col) > 0, F.get(F.transform(F.array(F.col(col)), shortened), 0))
                           .otherwise(F.col(col)))


# --- fixed values: words of closed classes (German, English, French, Spanish), by part of speech ---
CLOSED_CLASSES = {
    "DET": ("der", "die", "das", "den", "dem", "des", "ein", "eine", "einen", "einem", "the", "a", "an", "this", "that",
            "le", "la", "les", "un", "une", "el", "los", "las", "una"),
    "PRON": ("ich", "du", "er", "sie", "es", "wir", "ihr", "sich", "i", "you", "he", "she", "it", "we", "they",
             "je", "tu", "il", "elle", "nous", "vous", "que", "qui", "se"),
    "ADP": ("in", "auf", "mit", "von", "zu", "bei", "aus", "für", "of", "to", "for", "with", "on", "at", "by", "from",
            "de", "du", "dans", "pour", "sur", "par", "en", "con", "para", "por", "del"),
    "CCONJ": ("und", "oder", "aber", "and", "or", "but", "et", "ou", "mais", "y", "o", "pero"),
    "SCONJ": ("dass", "weil", "wenn", "ob", "because", "if", "while", "although", "si", "quand", "porque", "aunque"),
    "AUX": ("ist", "sind", "war", "hat", "wird", "is", "are", "was", "were", "be", "has", "have", "est", "sont", "son"),
    "PART": ("nicht", "not", "ne", "pas", "no"),
    "INTJ": ("ach", "oh", "hallo", "hello", "hola"),
}
_TAG_OF = {word: tag for tag, words in CLOSED_CLASSES.items() for word in words}


def closed_class_tags(words: list[str]) -> list[str]:
    """Default tagger of the training job: words of closed classes by list, in any case of letters; NUM for
    digits, X for other single characters, NOUN for the rest. A model that sees the whole
    text can stand in its place: any function from a document's tokens to as many tags."""
    number = lambda w: all(unicodedata.category(c).startswith("N") for c in w)
    return [_TAG_OF.get(w.lower()) or ("NUM" if number(w) else "X" if len(w) == 1 else "NOUN") for w in words]


#: Words that leave Python with their tags at a time, at most, unless one document has more.
TAGGED_WORDS = 50_000


def tag_tokens(docs: DataFrame, tagger: Callable[[list[str]], list[str]] = closed_class_tags,
               col: str = "tokens", out: str = "tagged") -> DataFrame:
    """``out``: ``array<struct<token, tag>>`` from a tagger in Python, by batches of documents (Arrow).

    Python holds the words of one document at a time: the tokens of a batch stay Arrow's, and its tags become so
    document by document. The tagged documents leave Python in slices, so besides the batch that Spark has sent
    no more than ``TAGGED_WORDS`` words (or one document's) are there with their tags.
    """
    @F.arrow_udf("array<struct<token:string,tag:string>>")
    def tag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for tokens in batches:
            for piece in word_slices(tokens, TAGGED_WORDS):
                yield tagged_lists(piece, tagger)
            del tokens, piece  # before the next batch is read
            pa.default_memory_pool().release_unused()

    return docs.withColumn(out, tag(F.col(col)))


def word_slices(tokens: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Cut Arrow lists into slices of at most ``limit`` words, or one list; an empty array is one slice."""
    ends = np.cumsum(tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < max(len(tokens), 1):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield tokens.slice(start, stop - start)
        start = stop


def tagged_lists(tokens: pa.Array, tagger: Callable[[list[str]], list[str]]) -> pa.Array:
    """The Arrow lists of tokens as lists of ``struct<token, tag>``."""
    def row(words: list[str]):
        tags = tagger(words)
        if len(tags) != len(words):
            raise ValueError(f"{len(tags)} tags for {len(words)} tokens")
        return pa.array(tags, pa.string())

    tags = [row(t.as_py()) for t in tokens if t.is_valid]
    tags = pa.concat_arrays(tags) if tags else pa.array([], pa.string())
    words = tokens.flatten().cast(pa.string())  # of valid lists only, in order
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    pairs = pa.StructArray.from_arrays([words, tags], ["token", "tag"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs, mask=tokens.is_null())


def token_class(word: Column) -> Column:
    """Default tagger: NUM for digits only, CHAR for a single character, WORD otherwise.

    These classes share no name with part-of-speech tags.
    """
    return F.when(word.rlike(r"^\p{N}+$"), F.lit("NUM")) \
        .when(F.length(word) == 1, F.lit("CHAR")).otherwise(F.lit("WORD"))


def drop_tags(docs: DataFrame, excluded: Iterable[str], tagger: Callable[[Column], Column] = token_class,
              col: str = "tokens", tagged_col: str | None = None) -> DataFrame:
    """Remove tokens whose tag is excluded (row-local, order kept).

    ``tagged_col`` names an ``array<struct<token, tag>>`` column from a tagger that saw the
    whole text (a pandas UDF, say); without it ``tagger`` gives a Column per token. Tokens
    that earlier steps left out of ``col`` stay out: each token takes the tag of its next
    mention among the tagged ones, and a token without one has no tag and stays. Where
    ``docs`` have no ``col`` yet, the tagged tokens are taken.
    """
    excluded = list(excluded)
    if tagged_col is not None:
        words = F.transform(tagged_col, lambda x: x["token"])
        if col not in docs.columns:
            docs = docs.withColumn(col, words)

        def judged(a: Column, w: Column) -> Column:
            found = F.array_position(F.slice(words, a["at"] + 1, F.size(words)), w).cast("int")
            at = a["at"] + F.coalesce(found, F.lit(0))
            gone = F.coalesce((found > 0) & F.get(F.col(tagged_col), at - 1)["tag"].isin(*excluded), F.lit(False))
            return F.struct(at.alias("at"), F.concat(a["kept"], F.when(gone, none).otherwise(F.array(w))).alias("kept"))

        none = F.array().cast("array<string>")
        start = F.struct(F.lit(0).alias("at"), none.alias("kept"))
        untouched = F.transform(F.filter(tagged_col, lambda x: ~F.coalesce(x["tag"].isin(*excluded), F.lit(False))), lambda x: x["token"])
        return docs.withColumn(col, F.when(F.col(col).eqNullSafe(words), untouched)
                               .otherwise(F.aggregate(col, start, judged, lambda a: a["kept"])))
    return docs.withColumn(col, F.filter(col, lambda w: ~F.coalesce(tagger(w).isin(*excluded),
                                                                     F.lit(False))))


#: A token pipeline: each step takes and returns the documents.
TokenStep = Callable[[DataFrame], DataFrame]


def run_pipeline(docs: DataFrame, steps: Iterable[TokenStep]) -> DataFrame:
    """Apply the steps in order."""
    for step in steps:
        docs = step(docs)
    return docs


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (a broadcast of one row)."""
    return df.withColumn("__one", F.lit(1)).join(
        F.broadcast(scalar.withColumn("__one", F.lit(1))), "__one").drop("__one")


def df_interval(docs: DataFrame, min_num: int = 10, max_rate: float = 0.25,
                interval_open: bool = False, col: str = "tokens") -> DataFrame:
    """Keep words whose document frequency lies in ``[min_num, max_rate * N]``.

    Counts only the tokens still selected; N is the number of documents. The words of most documents,
    those above ``max_rate`` first, are judged inside their rows.
    """
    n = docs.agg(F.count(F.lit(1)).alias("__n"))
    dfs = materialize(with_scalar(token_words(docs, col), n), "frequencies")
    if interval_open:
        ok = (F.col("df") > min_num) & (F.col("df") < F.col("__n") * F.lit(max_rate))
    else:
        ok = (F.col("df") >= min_num) & (F.col("df") <= F.col("__n") * F.lit(max_rate))
    return filter_tokens(docs, dfs.where(ok).select("word"), col, hot=hot_words(dfs, "df"))


def drop_short_sentences(docs: DataFrame, min_len: int = 6, text_col: str = "raw_text",
                         out: str = "tokens", pattern: str = TOKEN_PATTERN,
                         sentence_pattern: str = SENTENCE_PATTERN) -> DataFrame:
    """Tokens of the sentences that have at least ``min_len`` tokens."""
    sentences = F.split(F.col(text_col), sentence_pattern)
    toks = F.transform(sentences, lambda s: F.regexp_extract_all(s, F.lit(pattern), 0))
    return docs.withColumn(out, F.flatten(F.filter(toks, lambda t: F.size(t) >= min_len)))


def drop_short_docs(corpus: Corpus, min_tokens: int = 20) -> Corpus:
    """Keep documents with at least ``min_tokens`` tokens."""
    return subset_docs(corpus, corpus.docs.where(F.size("tokens") >= min_tokens).select("doc_id"))


def bag_of_words(corpus: Corpus, words: DataFrame | None = None, max_count: int | None = None) -> Corpus:
    """``bow(doc_id, word, n)``; ``max_count`` caps n (for one-byte storage), by
    default it is the true count.

    Words are counted inside their document's row, without a shuffle; the vocabulary is only
    made when it is read. With ``words`` the vocabulary is given: unknown words are ignored, unused
    words stay in ``vocab`` (zero columns), and tokens are synced to it (G12).
    """
    out = corpus
    if words is not None:
        vocab = words.select("word").distinct()
        out = out.with_(docs=filter_tokens(corpus.docs, vocab))
    bow = out.docs.select("doc_id", F.explode(_word_counts(F.col("tokens"))).alias("c")).select(
        "doc_id", "c.word", (F.col("c.n") if max_count is None else F.least("c.n", F.lit(max_count))).alias("n"))
    return out.with_(bow=bow, words=None if words is None else vocab)


def _word_counts(tokens: Column) -> Column:
    """The distinct words of a list with their numbers, inside the row: runs of the sorted list."""
    def counted(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def runs(at: Column) -> Column:
            ends = F.concat(F.slice(at, F.lit(2), n), F.array(n))
            return F.zip_with(at, ends, lambda a, e: F.struct(F.get(s, a).alias("word"), (e - a).alias("n")))

        return F.get(F.transform(F.array(starts), runs), 0)

    present = F.filter(tokens, lambda w: w.isNotNull())
    return F.when(F.size(present) > 0, F.get(F.transform(F.array(F.sort_array(present)), counted), 0))


def bow_from_raw(corpus: Corpus, words: DataFrame | None = None, **kw) -> Corpus:
    """Tokenise then bag of words."""
    return bag_of_words(corpus.with_(docs=tokenise(corpus.docs, **kw)), words)


def drop_long_tokens(corpus: Corpus, max_len: int = 30) -> Corpus:
    """Remove words longer than ``max_len`` characters (vocab, bow, tokens).

    The rule looks at the word alone, so each table is filtered where it is.
    """
    short = F.length("word") <= max_len
    out = corpus.with_(words=None if corpus.words is None else corpus.words.where(short), bow=corpus.bow.where(short))
    if "tokens" in corpus.docs.columns:
        out = out.with_(docs=corpus.docs.withColumn("tokens", F.coalesce(
            F.filter("tokens", lambda w: F.length(w) <= max_len), F.array().cast("array<string>"))))
    return out


def bow_stats(corpus: Corpus) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, length)`` and ``(word, support)``, zero rows included."""
    lens = corpus.bow.groupBy("doc_id").agg(F.sum("n").cast("long").alias("length"))
    doc_len = corpus.docs.select("doc_id").join(lens, "doc_id", "left") \
        .select("doc_id", F.coalesce("length", F.lit(0)).cast("long").alias("length"))
    sup = corpus.bow.groupBy("word").agg(F.count(F.lit(1)).alias("support"),
                                         F.sum("n").cast("long").alias("total"))
    word_sup = corpus.vocab.select("word").join(sup, "word", "left").select(
        "word", F.coalesce("support", F.lit(0)).cast("long").alias("support"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"))
    return doc_len, word_sup
