"""TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.selection import dealt_join
from wordloom.storage import listed, stored


def tfidf(
    frequencies: DataFrame, document_counts: DataFrame, total_documents: int | None = 10_000
) -> DataFrame:
    """``doc_id, term, tfidf`` with ``tf * log10(total_documents / (df + 1))``.

    ``frequencies`` is a table of ``doc_id, term, tf``; for a dense one
    :func:`~wordloom.operators.dense_scores` needs no join. ``document_counts`` gives
    ``term, df``. A term without a count is taken to be in one document. The number of
    documents is a parameter; ``None`` takes the number of documents that ``frequencies``
    has, which is stored then, so that it is computed once.

    The counts are stored and measured. Small ones are sent to all tasks; larger ones are
    joined by term, and the terms that have most rows are dealt over several tasks.
    """
    counts = listed(document_counts.select("term", "df"), "df")
    if total_documents is None:
        frequencies = stored(frequencies)
        total_documents = frequencies.select("doc_id").distinct().count()
    if counts.small:
        looked_up = frequencies.join(F.broadcast(counts.terms), "term", "left")
    else:
        rows = stored(frequencies.withColumnRenamed("term", "word"))
        looked_up = dealt_join(rows, counts.terms, "word", "left", F.col("doc_id"))
        looked_up = looked_up.drop("term").withColumnRenamed("word", "term")
    df = F.coalesce(F.col("df"), F.lit(1))
    weight = F.log10(F.lit(float(total_documents)) / (df + 1))
    return looked_up.select("doc_id", "term", (F.col("tf") * weight).alias("tfidf"))


def scored_terms(vocabulary: DataFrame, document_counts: DataFrame) -> DataFrame:
    """``term``: the terms of a vocabulary and of a table of counts, each once.

    They differ when the vocabulary was normalised and the counts were read as they are.
    """
    term = F.col(vocabulary.columns[0]).alias("term")
    return vocabulary.select(term).union(document_counts.select("term")).distinct()
