"""The registered queries of this subpackage and the SQL some are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.centroids import check_sql as centroid_sql
from wordloom.llm.centroids import cluster_vectors
from wordloom.llm.common import stored, table
from wordloom.llm.decontamination import CHECK_SQL as LEAK_SQL
from wordloom.llm.decontamination import leak_report
from wordloom.llm.fingerprints import fingerprint_report
from wordloom.llm.fixity import CHECK_SQL as FIXITY_SQL
from wordloom.llm.fixity import audit, lay_out, warc_record
from wordloom.llm.html_pages import extract_pages
from wordloom.llm.jaccard import jaccard_components
from wordloom.llm.mixing import check_sql as mixing_sql
from wordloom.llm.mixing import sample_mix, topic_of
from wordloom.llm.ngram_scores import backoff_scores
from wordloom.llm.packing import Capacity, pack_documents
from wordloom.llm.quality import CHECK_SQL as QUALITY_SQL
from wordloom.llm.quality import clean_lines
from wordloom.llm.token_counts import count_tokens
from wordloom.llm.toxicity import held_out, score_toxicity, train
from wordloom.llm.whitening import whiten_vectors

Query = Callable[[SparkSession, str], DataFrame]


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(documents, path, Capacity(tokens=2048))


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_report(table(spark, folder, "documents"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean_lines(table(spark, folder, "documents"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select("doc_id", *(f"quality.{name}" for name in fields))


#: The powers by which the query on mixing flattens each margin, and how it samples.
MIX = {"source": 0.5, "lang": 0.7, "topic": 0.5}
MIX_OPTIONS = {"share": 0.5, "seed": 17, "rounds": 6}


def words_in(text: str = "text") -> Column:
    """The number of words of a text, taken as its tokens."""
    inner = F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    words = F.regexp_count(inner, F.lit(r"[\x20\x09-\x0D]+")) + 1
    return F.when(inner != "", words).otherwise(0)


def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = sample_mix(
        table(spark, folder, "documents"),
        MIX,
        tokens=words_in(),
        topic=topic_of(F.col("text")),
        tolerance=0,  # a fixed number of rounds, as the SQL has
        **MIX_OPTIONS,
    )
    return rows.select(
        "doc_id",
        "source",
        "lang",
        "mixing.topic",
        "mixing.tokens",
        F.round("mixing.probability", 6).alias("probability"),
        "mixing.sampled",
    )


def warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """An audit of the archive of ``pages`` against a copy that went wrong in known ways:
    of 97 records one has its first character changed and one is lost."""
    pages = table(spark, folder, "pages")
    kind = F.col("page_id") % 97
    damaged = F.when(
        (kind == 5) & (F.coalesce("html", F.lit("")) != ""),
        F.concat(F.lit("?"), F.substring("html", 2, 2**31 - 1)),
    ).otherwise(F.coalesce("html", F.lit("")))
    # The copy's records are digested by themselves; the head of a record keeps the length
    # that was stated. A record of the copy lies where the one it was made from lies.
    stated = F.octet_length(F.coalesce("html", F.lit("")))
    held = F.sha2(warc_record(F.col("page_id"), F.col("url"), damaged, stated), 256)
    lost = F.coalesce(kind == 6, F.lit(False))
    rows = stored(lay_out(pages, carried={"held": held, "lost": lost}))
    copy = rows.filter("not lost").select("file", "offset", F.col("held").alias("digest"))
    return audit(rows.drop("held", "lost"), copy)


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return backoff_scores(table(spark, folder, "documents"), order=3)


def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), size=3, percent=90)


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train(documents, table(spark, folder, "labels").filter(~held_out()))
    rows = score_toxicity(documents, model)
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", F.size("clauses").alias("n_clauses")
    )


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, folder, "documents"), path, limit=1024)


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


def centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings"), k=16, rounds=3, seed=1)


def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leak_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten_vectors(table(spark, folder, "embeddings"), components=16)


def registered() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": best_fit_packing,
        "op2_document_fingerprints": document_fingerprints,
        "op3_quality_rules": quality_rules,
        "op4_source_mixing": source_mixing,
        "op5_warc_fixity": warc_fixity,
        "op6_ngram_jaccard_join": ngram_jaccard_join,
        "op7_lm_scoring": lm_scoring,
        "op8_toxicity": toxicity,
        "op9_token_counts": token_counts,
        "op10_html_extraction": html_extraction,
        "op11_centroid_clustering": centroid_clustering,
        "op12_benchmark_decontamination": benchmark_decontamination,
        "op13_embedding_whitening": embedding_whitening,
    }


def check_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return {
        "op3_quality_rules": QUALITY_SQL,
        "op4_source_mixing": mixing_sql(MIX, **MIX_OPTIONS),
        "op5_warc_fixity": FIXITY_SQL,
        "op11_centroid_clustering": centroid_sql(k=16, rounds=3, seed=1),
        "op12_benchmark_decontamination": LEAK_SQL,
    }
