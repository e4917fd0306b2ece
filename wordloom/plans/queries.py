"""Every query over the ``documents`` table, by name.

Each is a function of a session and a folder of Parquet tables and returns a DataFrame
that nothing has been computed of yet.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import (
    STOP_WORDS,
    alnum_tokens,
    document_id,
    letter_tokens,
    lines_of,
    pair_text,
    score_line,
    score_text,
    stripe_text,
    word_tokens,
)
from wordloom.operators import (
    cooccurrence_pairs,
    cooccurrence_stripe_pieces,
    cooccurrence_stripes,
    dense_scores,
    document_frequency,
    keyed_term_frequency,
    keyed_term_maps,
    scored_terms,
    stem_vocabulary,
    term_frequency,
    term_frequency_dense,
    tfidf,
    top_terms,
    top_words,
    word_count,
)
from wordloom.sinks import read_numbered_lines, tsv_lines, write_documents, write_tsv
from wordloom.sources import (
    document_table,
    documents_from_files,
    keyed_documents,
    term_counts,
    text_lines,
    vocabulary,
    word_list,
)
from wordloom.storage import new_path, stored

Query = Callable[[SparkSession, str], DataFrame]


#: A Spark setting, unset by default: partitions to deal the documents out to, for a table
#: that is one small file.
PARTITIONS = "spark.wordloom.documentPartitions"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    partitions = spark.conf.get(PARTITIONS, None)
    path = f"{folder}/documents.parquet"
    return document_table(spark, path, partitions=int(partitions) if partitions else None)


# Words


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return word_count(_documents(spark, folder), STOP_WORDS)


def word_counts_with_case(spark: SparkSession, folder: str) -> DataFrame:
    return word_count(_documents(spark, folder), STOP_WORDS, case_sensitive=True)


def word_counts_joined(spark: SparkSession, folder: str) -> DataFrame:
    return word_count(_documents(spark, folder), _language_codes(spark, folder))


def top50_words(spark: SparkSession, folder: str) -> DataFrame:
    return top_words(word_counts(spark, folder), 50)


def token_counts(tokens: Callable, spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder).select("doc_id", F.explode(tokens("text")).alias("token"))
    return rows.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("cnt"))


# Co-occurrence


def pairs(mode: str, distance: int, spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    words = top_words(word_count(documents, STOP_WORDS), 50)
    return cooccurrence_pairs(text_lines(documents), words, distance, mode)


def pair_lines(mode: str, distance: int, spark: SparkSession, folder: str) -> DataFrame:
    rows = pairs(mode, distance, spark, folder)
    return tsv_lines(rows.select(pair_text("word", "coword").alias("pair"), "cnt"))


def stripes(distance: int, spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    words = top_words(word_count(documents, STOP_WORDS), 50)
    rows = cooccurrence_stripes(text_lines(documents), words, distance)
    return rows.select("word", stripe_text("stripe").alias("stripe"))


def stripe_pieces(distance: int, entries: int, spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    words = top_words(word_count(documents, STOP_WORDS), 50)
    rows = cooccurrence_stripe_pieces(text_lines(documents), words, distance, entries=entries)
    return rows.select("word", "part", stripe_text("stripe").alias("stripe"))


def pairs_of_all_words(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours over the whole vocabulary of the corpus, not only its top."""
    documents = _documents(spark, folder)
    return cooccurrence_pairs(
        text_lines(documents), word_count(documents, STOP_WORDS), 1, large_vocabulary=True
    )


# Terms and documents


def stemmed_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return stem_vocabulary(_documents(spark, folder), STOP_WORDS)


def _by_line(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a line reader gives them: many rows with the same id."""
    return _documents(spark, folder).select(
        "doc_id", F.explode(lines_of("text")).alias("text")
    )


def _language_codes(spark: SparkSession, folder: str) -> DataFrame:
    """A stop list kept in a table: the language codes of the corpus."""
    table = spark.read.parquet(f"{folder}/documents.parquet")
    return word_list(table.select(F.col("lang").alias("value")))


def document_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return document_frequency(_documents(spark, folder), STOP_WORDS, assume_unique_ids=True)


def document_frequencies_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return document_frequency(_by_line(spark, folder), STOP_WORDS)


def document_frequencies_joined(spark: SparkSession, folder: str) -> DataFrame:
    return document_frequency(_documents(spark, folder), _language_codes(spark, folder))


def top100_terms(spark: SparkSession, folder: str) -> DataFrame:
    return top_terms(document_frequencies(spark, folder), 100)


def term_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    terms = top100_terms(spark, folder)
    return term_frequency(_documents(spark, folder), terms, STOP_WORDS, assume_unique_ids=True)


def term_frequencies_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return term_frequency(_by_line(spark, folder), top100_terms(spark, folder), STOP_WORDS)


def term_frequencies_dense(spark: SparkSession, folder: str) -> DataFrame:
    terms = top100_terms(spark, folder)
    return term_frequency_dense(
        _documents(spark, folder), terms, STOP_WORDS, assume_unique_ids=True
    )


def term_frequencies_dense_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return term_frequency_dense(_by_line(spark, folder), top100_terms(spark, folder), STOP_WORDS)


def term_frequencies_dense_joined(spark: SparkSession, folder: str) -> DataFrame:
    terms = top_terms(document_frequencies_joined(spark, folder), 100)
    return term_frequency_dense(_documents(spark, folder), terms, _language_codes(spark, folder))


def _scores(spark: SparkSession, folder: str, total_documents: int | None = 10_000) -> DataFrame:
    terms = top100_terms(spark, folder)
    documents = _documents(spark, folder)
    return dense_scores(
        documents, terms, terms, STOP_WORDS, assume_unique_ids=True, total_documents=total_documents
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    rounded = F.round("tfidf", 6) + F.lit(0.0)
    return _scores(spark, folder).select("doc_id", "term", rounded.alias("tfidf"))


def scores_of_corpus_size(spark: SparkSession, folder: str) -> DataFrame:
    """With the number of documents of the corpus in place of the default."""
    rows = _scores(spark, folder, total_documents=None)
    return rows.select("doc_id", "term", (F.round("tfidf", 6) + F.lit(0.0)).alias("tfidf"))


def _term_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The top terms as a hand-kept file: some in capitals after a blank, and some lines
    with a third field, which are no counts."""
    even = F.length("term") % 2 == 0
    term = F.when(even, F.concat(F.lit(" "), F.upper("term"))).otherwise(F.col("term"))
    more = F.when(F.length("term") % 3 == 0, "\tmore").otherwise("")
    line = F.concat(term, F.lit("\t"), F.col("df").cast("string"), more)
    return top100_terms(spark, folder).select(line.alias("value"))


def sparse_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Only the terms that a document has, of the whole corpus and not of its top."""
    counts = document_frequencies(spark, folder)
    rows = tfidf(term_frequency(_documents(spark, folder), counts, STOP_WORDS, assume_unique_ids=True), counts)
    return rows.select("doc_id", "term", (F.round("tfidf", 6) + F.lit(0.0)).alias("tfidf"))


def scores_from_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of the normalised vocabulary and of the raw counts, scored by the raw counts;
    a term without one counts as being in one document."""
    file_lines = _term_lines(spark, folder)
    counts = term_counts(file_lines)
    terms = scored_terms(vocabulary(file_lines, normalise=True), counts)
    rows = dense_scores(_documents(spark, folder), terms, counts, STOP_WORDS, assume_unique_ids=True)
    return rows.select("doc_id", "term", (F.round("tfidf", 6) + F.lit(0.0)).alias("tfidf"))


def tfidf_tsv_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder).select(score_line("doc_id", "term", "tfidf").alias("value"))


def stripe_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    words = top_words(word_count(documents, STOP_WORDS), 50)
    return tsv_lines(cooccurrence_stripes(text_lines(documents), words, 2))


def score_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = _scores(spark, folder)
    return rows.select("doc_id", "term", score_text("tfidf").alias("score"))


# Files


def pair_files(files: int, spark: SparkSession, folder: str) -> DataFrame:
    """Counted pairs written in the order of their words, as files that follow each other,
    and read back with their places."""
    path = new_path(spark, "files")
    write_tsv(pairs("within", 2, spark, folder), path, order_by=["word", "coword"], files=files)
    return read_numbered_lines(spark, path)


def score_files(files: int, spark: SparkSession, folder: str) -> DataFrame:
    """Scores written by document and, in each, by term; a line is numbered over all files."""
    path = new_path(spark, "files")
    rows = _scores(spark, folder).select("doc_id", "term", score_text("tfidf").alias("score"))
    write_tsv(rows, path, order_by=["doc_id", "term"], files=files)
    lines = read_numbered_lines(spark, path)
    sizes = lines.groupBy("file_number").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a file
    sizes = sorted((r["file_number"], r["n"]) for r in sizes)
    before = [(number, sum(n for _, n in sizes[:i])) for i, (number, _) in enumerate(sizes)]
    starts = spark.createDataFrame(before, "file_number int, start long")
    numbered = lines.join(F.broadcast(starts), "file_number")
    return numbered.select((F.col("start") + F.col("line_number")).alias("line_number"), "value")


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Document frequencies of a corpus of files: the documents are written as a file each
    and read by their names. ``first_df`` is from documents with an even id, which are
    written first; they are not written over unless that is asked for, and then all are."""
    path = new_path(spark, "files")
    documents = _documents(spark, folder)

    def counted() -> DataFrame:
        return document_frequency(documents_from_files(spark, path), STOP_WORDS)

    write_documents(documents.filter("doc_id % 2 = 0"), path)
    first = stored(counted().withColumnRenamed("df", "first_df"))
    try:
        write_documents(documents, path)
    except AnalysisException as error:
        if "PATH_ALREADY_EXISTS" not in str(error):
            raise
    else:
        raise AssertionError("an existing path was written to")
    write_documents(documents, path, overwrite=True)
    rows = counted().join(first, "term", "left")
    return rows.select("term", "df", F.coalesce("first_df", F.lit(0)).alias("first_df"))


# Keyed records


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id TAB line`` records for every line of every document, parsed again."""
    lines = _by_line(spark, folder)
    records = lines.select(F.concat_ws("\t", F.col("doc_id").cast("string"), "text").alias("value"))
    return keyed_documents(records)


def keyed_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return keyed_term_frequency(_keyed(spark, folder), top50_words(spark, folder))


def keyed_maps(spark: SparkSession, folder: str) -> DataFrame:
    rows = keyed_term_maps(_keyed(spark, folder), top50_words(spark, folder))
    return rows.groupBy("doc_id", stripe_text("tf").alias("tf")).agg(F.count(F.lit(1)).alias("n"))


# Readers and writers on lines made from the corpus


def lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = text_lines(_documents(spark, folder))
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("cnt"))


def line_words(spark: SparkSession, folder: str) -> DataFrame:
    return word_list(text_lines(_documents(spark, folder)))


def document_ids(spark: SparkSession, folder: str) -> DataFrame:
    names = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id",
        F.concat("source", F.lit("/"), "lang", F.lit(".v1."), "doc_id", F.lit(".txt")).alias("path"),
    )
    return names.select("doc_id", document_id("path").alias("file_id"))


def _count_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts as a hand-kept file: some words in capitals, blanks around them."""
    counts = word_counts(spark, folder)
    word = F.when(F.length("word") % 2 == 0, F.concat(F.lit(" "), F.upper("word"))).otherwise(F.col("word"))
    return tsv_lines(counts.select(word.alias("word"), "cnt"))


def vocabulary_raw(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary(_count_lines(spark, folder))


def vocabulary_normalised(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary(_count_lines(spark, folder), normalise=True)


def parsed_counts(spark: SparkSession, folder: str) -> DataFrame:
    return term_counts(_count_lines(spark, folder))


def parsed_counts_guarded(spark: SparkSession, folder: str) -> DataFrame:
    """A file of word counts of which a part is sound: in the others the count is no
    number, or missing, or followed by a third field."""
    count = F.col("cnt").cast("string")
    rest = (
        F.when(F.length("word") % 4 == 0, F.concat(F.lit("\t"), count))
        .when(F.length("word") % 4 == 1, F.concat(F.lit("\t"), count, F.lit("x")))
        .when(F.length("word") % 4 == 2, F.lit(""))
        .otherwise(F.concat(F.lit("\t"), count, F.lit("\tmore")))
    )
    lines = word_counts(spark, folder).select(F.concat("word", rest).alias("value"))
    return term_counts(lines, digits_only=True)


def terms_of_both_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The same file read as a normalised vocabulary and as raw counts."""
    file_lines = _count_lines(spark, folder)
    return scored_terms(vocabulary(file_lines, normalise=True), term_counts(file_lines))


def vocabulary_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tsv_lines(top100_terms(spark, folder))


def registered() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "top50_words": top50_words,
        "word_counts": word_counts,
        "word_counts_with_case": word_counts_with_case,
        "word_counts_joined": word_counts_joined,
        "word_tokens": partial(token_counts, word_tokens),
        "letter_tokens": partial(token_counts, letter_tokens),
        "alnum_tokens": partial(token_counts, alnum_tokens),
        "cooc_pairs_exact_d0": partial(pairs, "exact", 0),
        "cooc_pair_lines_d2": partial(pair_lines, "within", 2),
        "cooc_pairs_all_words_d1": pairs_of_all_words,
    }
    for d in (1, 2, 3, 4):
        queries[f"cooc_pairs_exact_d{d}"] = partial(pairs, "exact", d)
        queries[f"cooc_pairs_within_d{d}"] = partial(pairs, "within", d)
        queries[f"cooc_stripes_d{d}"] = partial(stripes, d)
    queries |= {
        "stemmed_vocabulary": stemmed_vocabulary,
        "document_frequency": document_frequencies,
        "document_frequency_by_line": document_frequencies_by_line,
        "document_frequency_joined": document_frequencies_joined,
        "top100_terms": top100_terms,
        "term_frequency": term_frequencies,
        "term_frequency_by_line": term_frequencies_by_line,
        "term_frequency_dense": term_frequencies_dense,
        "term_frequency_dense_by_line": term_frequencies_dense_by_line,
        "term_frequency_dense_joined": term_frequencies_dense_joined,
        "tfidf": scores,
        "tfidf_corpus_size": scores_of_corpus_size,
        "tfidf_from_lists": scores_from_lists,
        "tfidf_sparse": sparse_scores,
        "tfidf_tsv_lines": tfidf_tsv_lines,
        "stripe_lines": stripe_lines,
        "cooc_stripe_pieces_d2": partial(stripe_pieces, 2, 7),
        "cooc_pair_files": partial(pair_files, 4),
        "tfidf_files": partial(score_files, 4),
        "document_files": document_files,
        "tfidf_lines": score_lines,
        "keyed_term_frequency": keyed_frequencies,
        "keyed_term_maps": keyed_maps,
        "text_lines": lines,
        "word_list": line_words,
        "document_ids": document_ids,
        "vocabulary_raw": vocabulary_raw,
        "vocabulary_normalised": vocabulary_normalised,
        "term_counts": parsed_counts,
        "term_counts_guarded": parsed_counts_guarded,
        "scored_terms": terms_of_both_lists,
        "vocabulary_lines": vocabulary_lines,
    }
    return queries
