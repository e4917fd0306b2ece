"""Word counts and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.tokens import word_tokens
from wordloom.operators.selection import Words, remove_stop_words


def word_count(
    corpus: DataFrame,
    stop_words: Words = None,
    case_sensitive: bool = False,
    column: str = "text",
) -> DataFrame:
    """``word, cnt``: occurrences of every word that is not a stop word.

    Tokens never cross a line end, so whole documents need not be cut into lines first.
    Counting starts on the map side; a hot word costs one row per task in the shuffle.
    """
    words = corpus.select(F.explode(word_tokens(column, case_sensitive)).alias("word"))
    count = F.count(F.lit(1)).alias("cnt")
    if isinstance(stop_words, DataFrame):
        # Counted first: if the list cannot be broadcast, counted words meet it.
        return remove_stop_words(words.groupBy("word").agg(count), stop_words)
    return remove_stop_words(words, stop_words).groupBy("word").agg(count)


def top_words(counts: DataFrame, k: int = 50) -> DataFrame:
    """``word, cnt``: the k most frequent words of the whole corpus, ties by word."""
    return counts.orderBy(F.desc("cnt"), F.asc("word")).limit(k)


def top_terms(frequencies: DataFrame, k: int = 100, min_length: int = 3) -> DataFrame:
    """``term, df``: the k terms in most documents, ties by term, short terms left out."""
    long_enough = frequencies.filter(F.length("term") >= min_length)
    return long_enough.orderBy(F.desc("df"), F.asc("term")).limit(k)
