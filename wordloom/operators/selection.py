"""Keeping and dropping rows by a word list.

A list is a short Python sequence or a DataFrame. A sequence is already in the driver
and becomes a constant set inside the generated code. A DataFrame meets what operators
have counted and not single occurrences. Where a word still has many rows (one for every
document, say) the list is stored and measured: a small one is sent to all tasks, and for
a larger one the words that have most rows are found from the counted rows themselves.
Those alone are dealt over several tasks, as many as their rows ask for, and only their
entries of the list are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.storage import Listed, listed, stored

Words = Sequence[str] | DataFrame | None

#: The share of all rows above which a word is dealt over several tasks.
HEAVY_SHARE = 1 / 64


def heavy_words(rows: DataFrame, column: str, share: float = HEAVY_SHARE) -> DataFrame:
    """``term, parts`` of the words with more than the share of all rows: ``parts`` says
    over how many tasks they go, so that none gets more than the share of one word.

    At most ``1 / share`` words can be so frequent, which bounds the table.
    """
    counts = stored(rows.groupBy(F.col(column).alias("term")).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    parts = F.ceil(F.col("n") / F.lit(max(total * share, 1.0))).cast("int")
    return counts.select("term", parts.alias("parts")).filter("parts > 1")


def _join(
    rows: DataFrame, words: DataFrame | Listed, column: str, how: str, spread: Column | None
) -> DataFrame:
    """All columns of ``rows`` (and ``term``, null where there is none, for a left join)."""
    if spread is None:
        terms = words.select(F.col(words.columns[0]).alias("term"))
        return rows.join(terms, rows[column] == terms["term"], how)
    known = words if isinstance(words, Listed) else listed(words)
    if known.small:
        terms = F.broadcast(known.terms)
        return rows.join(terms, rows[column] == terms["term"], how)
    return dealt_join(stored(rows), known.terms, column, how, spread)


def dealt_join(
    rows: DataFrame, terms: DataFrame, column: str, how: str, spread: Column
) -> DataFrame:
    """``rows`` joined with a table that has a ``term`` once, by that and ``column``; the
    rows of heavy words are dealt by a hash of ``spread``. Reads ``rows`` twice."""
    heavy = F.broadcast(heavy_words(rows, column).withColumnRenamed("term", "_heavy"))
    part = F.pmod(F.xxhash64(spread), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = rows.join(heavy, F.col(column) == F.col("_heavy"), "left").withColumn("_part", part)
    dealt = dealt.drop("_heavy", "parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("_of")
    named = terms.join(heavy, F.col("term") == F.col("_heavy"), "left").select(*terms.columns, every)
    same = (F.col(column) == F.col("_term")) & (F.col("_part") == F.col("_of"))
    joined = dealt.join(named.withColumnRenamed("term", "_term").hint("merge"), same, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_part")
    return joined.drop("_part", "_of").withColumnRenamed("_term", "term")


def remove_stop_words(
    rows: DataFrame, words: Words, column: str = "word", spread: Column | None = None
) -> DataFrame:
    """The rows whose word is not in the list."""
    if isinstance(words, DataFrame):
        return _join(rows, words, column, "left_anti", spread)
    return rows.filter(~F.col(column).isin(list(words))) if words else rows


def keep_vocabulary(
    rows: DataFrame,
    vocabulary: DataFrame | Listed,
    column: str = "word",
    spread: Column | None = None,
) -> DataFrame:
    """The rows whose word is in the vocabulary, that is in its first column."""
    return _join(rows, vocabulary, column, "left_semi", spread)


def of_known_size(words: DataFrame) -> DataFrame:
    """A list that joins can plan for: itself if Spark knows it to be small enough for a
    broadcast, else stored and measured, with a hint if it turns out to be small."""
    session = words.sparkSession._jsparkSession.sessionState()
    estimate = int(str(words._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate <= session.conf().autoBroadcastJoinThreshold():
        return words
    known = listed(words)
    return F.broadcast(known.terms) if known.small else known.terms
