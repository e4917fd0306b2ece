"""Terms per document: stemming, document frequency, term frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.stemming import counts_within, stem_counts, stem_token, token_counts
from wordloom.functions.tokens import alnum_tokens, letter_tokens, without
from wordloom.operators.dense import BLOCK_TERMS, block_of, lay_over, term_blocks
from wordloom.operators.selection import (
    Words,
    keep_vocabulary,
    remove_stop_words,
)
from wordloom.storage import Listed, listed, stored


def stem_vocabulary(corpus: DataFrame, stop_words: Words = None) -> DataFrame:
    """``token, term``: the distinct tokens that are no stop words, with their stems."""
    tokens = corpus.select(F.explode(letter_tokens("text")).alias("token")).distinct()
    kept = remove_stop_words(tokens, stop_words, "token")
    return kept.select("token", stem_token("token").alias("term"))


def _row_counts(
    corpus: DataFrame,
    stop_words: Sequence[str],
    distinct: bool = False,
    vocabulary: Listed | None = None,
) -> DataFrame:
    """``doc_id, found``: the distinct stems of each row with their counts in it, those of
    a small vocabulary only where one is given.

    Stemming row by row needs no shuffle, where a join with a stemmed vocabulary would
    move every token of the corpus. With ``distinct`` every token counts once, for callers
    that do not look at the counts.
    """
    tokens = letter_tokens("text")
    tokens = without(F.array_distinct(tokens) if distinct else tokens, stop_words)
    counts = counts_within(vocabulary.sent(), True) if vocabulary else stem_counts
    return corpus.select("doc_id", counts(tokens).alias("found"))


def _joined_counts(corpus: DataFrame, stop_words: DataFrame, distinct: bool = False) -> DataFrame:
    """``doc_id, term, tf`` without the words of a table: one row per distinct token of a
    row of the corpus, so a term has as many as it has tokens and, where ids repeat, rows.
    The table meets tokens counted in their row, which takes no shuffle; all callers add
    up or make distinct what a document has of a term. With ``distinct`` every count is 1."""
    tokens = letter_tokens("text")
    if distinct:
        token = F.explode(F.array_distinct(tokens)).alias("token")
        counted = corpus.select("doc_id", token, F.lit(1).cast("bigint").alias("tf"))
    else:
        found = corpus.select("doc_id", token_counts(tokens).alias("found"))
        counted = found.select("doc_id", F.inline("found").alias("token", "tf"))
    kept = remove_stop_words(counted, stop_words, "token", spread=F.col("doc_id"))
    return kept.select("doc_id", stem_token("token").alias("term"), "tf")


def _counts(
    corpus: DataFrame,
    stop_words: Words,
    distinct: bool = False,
    vocabulary: Listed | None = None,
) -> DataFrame:
    if isinstance(stop_words, DataFrame):
        rows = _joined_counts(corpus, stop_words, distinct)
        return rows.join(F.broadcast(vocabulary.terms), "term", "left_semi") if vocabulary else rows
    rows = _row_counts(corpus, stop_words or (), distinct, vocabulary)
    return rows.select("doc_id", F.inline("found"))


def document_frequency(
    corpus: DataFrame, stop_words: Words = None, assume_unique_ids: bool = False
) -> DataFrame:
    """``term, df``: the number of distinct documents with the term.

    In general the (document, term) pairs are made distinct by a shuffle.
    ``assume_unique_ids`` says that no id is on two rows, which is not checked; then, with
    a stop list that is a sequence, the terms of a row are distinct already and only
    partial counts per term are shuffled. With a table of stop words one shuffle makes the
    stems of a document distinct, whatever the ids.
    """
    terms = _counts(corpus, stop_words, distinct=True).select("doc_id", "term")
    if isinstance(stop_words, DataFrame) or not assume_unique_ids:
        terms = terms.distinct()
    terms = terms.filter(F.length("term") > 0)
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def term_frequency(
    corpus: DataFrame,
    vocabulary: DataFrame,
    stop_words: Words = None,
    assume_unique_ids: bool = False,
) -> DataFrame:
    """``doc_id, term, tf``: occurrences of the vocabulary terms.

    Documents without such a term have no row. In general the rows of a document are
    added up by a shuffle of partial counts. If no id is on two rows, which
    ``assume_unique_ids`` asserts without a check, and the stop list is a sequence, the
    row is counted where it is.
    """
    counts = _counts(corpus, stop_words)
    kept = keep_vocabulary(counts, vocabulary, "term", spread=F.col("doc_id"))
    if assume_unique_ids and not isinstance(stop_words, DataFrame):
        return kept
    return kept.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))


def _per_block(
    corpus: DataFrame, vocabulary: Listed, stop_words: Words, assume_unique_ids: bool, blocks: int
) -> DataFrame:
    """``doc_id, block, found``: a row for every document and block, with the counts of the
    document's terms that belong to the block."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    known = vocabulary if vocabulary.small else None
    if assume_unique_ids and not isinstance(stop_words, DataFrame):
        rows = _row_counts(corpus, stop_words or (), vocabulary=known)
        if blocks == 1:
            # Not a literal, with which the plan would have a join without a key.
            return rows.select("doc_id", block_of("doc_id", 1).alias("block"), "found")
        rows = rows.select("doc_id", "found", numbers)
        own = F.filter("found", lambda x: block_of(x["term"], blocks) == F.col("block"))
        return rows.select("doc_id", "block", own.alias("found"))
    counts = _counts(corpus, stop_words, vocabulary=known)
    summed = counts.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    # Documents without any of the terms come from their ids alone.
    nothing = F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("tf")
    ids = corpus.select("doc_id") if blocks == 1 else corpus.select("doc_id").distinct()
    found = F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tf")))
    rows = summed.select("doc_id", block_of("term", blocks).alias("block"), "term", "tf")
    rows = rows.unionByName(ids.select("doc_id", numbers, *nothing))
    return rows.groupBy("doc_id", "block").agg(found.alias("found"))


def _dense(
    corpus: DataFrame,
    vocabulary: Listed,
    value: Column,
    stop_words: Words,
    assume_unique_ids: bool,
    block_terms: int,
) -> DataFrame:
    blocks = max(1, -(-vocabulary.count // block_terms))
    rows = _per_block(corpus, vocabulary, stop_words, assume_unique_ids, blocks)
    return lay_over(rows, term_blocks(vocabulary, value, blocks), vocabulary.small, blocks)


def term_frequency_dense(
    corpus: DataFrame,
    vocabulary: DataFrame,
    stop_words: Words = None,
    assume_unique_ids: bool = False,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``doc_id, term, tf`` for every document and every vocabulary term, zeros included.

    The vocabulary is evaluated once, at the call, and stored in blocks of about
    ``block_terms`` terms, which documents meet by the number of the block. Zeros are added
    there, once per document: where no id is on two rows (``assume_unique_ids``, not
    checked) and the stop list is a sequence, nothing but a large vocabulary is shuffled;
    otherwise the counts of a document are gathered by block before.
    """
    terms = listed(vocabulary)
    rows = _dense(corpus, terms, F.lit(0), stop_words, assume_unique_ids, block_terms)
    return rows.select("doc_id", "term", "tf")


def dense_scores(
    corpus: DataFrame,
    vocabulary: DataFrame,
    document_counts: DataFrame,
    stop_words: Words = None,
    assume_unique_ids: bool = False,
    total_documents: int | None = 10_000,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``doc_id, term, tfidf`` with ``tf * log10(total_documents / (df + 1))`` for every
    document and every vocabulary term.

    Each block of the vocabulary (see :func:`term_frequency_dense`) carries the weights of
    its terms, made once from ``document_counts`` (``term, df``), so the table of documents
    by terms meets no list of counts. A term without a count is taken to be in one document.
    ``total_documents=None`` counts the distinct ids of the corpus.
    """
    if total_documents is None:
        ids = corpus.select("doc_id")
        total_documents = (ids if assume_unique_ids else ids.distinct()).count()
    term = F.col(vocabulary.columns[0]).alias("term")
    if vocabulary is document_counts:
        counted = vocabulary.select(term, "df")
    else:
        df = document_counts.select("term", "df")
        counted = vocabulary.select(term).distinct().join(df, "term", "left")
    weight = F.log10(F.lit(float(total_documents)) / (F.coalesce("df", F.lit(1)) + 1))
    terms = listed(counted, "df")
    rows = _dense(corpus, terms, weight, stop_words, assume_unique_ids, block_terms)
    return rows.select("doc_id", "term", (F.col("tf") * F.col("value")).alias("tfidf"))


def keyed_term_frequency(keyed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``doc_id, term, tf`` of unstemmed tokens, for a vocabulary of any size."""
    tokens = keyed.select("doc_id", F.explode(alnum_tokens("text")).alias("term"))
    counts = tokens.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return keep_vocabulary(counts, vocabulary, "term", spread=F.col("doc_id"))


def keyed_term_maps(keyed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``doc_id, tf``: one map of counts per keyed record, empty if nothing matches.

    The tokens of a record are counted where it is, in one pass over them. A small
    vocabulary (it is stored and measured) comes to the records, and nothing is shuffled.
    For a larger one the records are stored with a number, their counted terms meet the
    vocabulary, and what it has of them is gathered by the number.
    """
    terms = listed(vocabulary)
    tokens = alnum_tokens("text")
    if terms.small:
        found = counts_within(terms.sent(), stemmed=False)(tokens)
        return keyed.select("doc_id", F.map_from_entries(found).alias("tf"))
    records = keyed.select("doc_id", token_counts(tokens).alias("found"))
    records = stored(records.withColumn("_record", F.monotonically_increasing_id()))
    counts = records.select("_record", F.inline("found"))
    kept = keep_vocabulary(counts, terms, "term", F.col("_record"))
    kept = kept.select("_record", "term", "tf").unionByName(
        records.select("_record", F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("tf"))
    )
    entries = F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tf")))
    gathered = kept.groupBy("_record").agg(F.array_sort(entries).alias("found"))
    named = records.select("_record", "doc_id").join(gathered, "_record")
    return named.select("doc_id", F.map_from_entries("found").alias("tf"))
