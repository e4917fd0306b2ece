"""Callers' columns may have any names, those that operators use themselves included."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from wordloom.llm import jaccard, packing, queries
from wordloom.llm.centroids import cluster_vectors
from wordloom.llm.decontamination import leak_report, remove_leaks
from wordloom.llm.fingerprints import fingerprint_report
from wordloom.llm.html_pages import extract_pages
from wordloom.llm.mixing import sample_mix
from wordloom.llm.ngram_scores import backoff_scores
from wordloom.llm.quality import clean_lines
from wordloom.llm.token_counts import count_tokens
from wordloom.llm.toxicity import remove_toxic, score_toxicity, train
from wordloom.llm.whitening import whiten_vectors

NAMES = (
    "_id _text _x _key key row rows _rows _row touched _touched goes _goes copies part block group _group "
    "gram prefix place places n wide tokens _tokens weight _weight fitted probability _probability draw "
    "own_tokens _m_source _m_topic topic mixing_ words _words lines windows _windows judged _judged repeated "
    "_repeated _filled _lost _cleaned _n_words _chars _symbols quality_ range before first extra falling head "
    "no_id sequence_id offset length start piece score predicted clauses leaks_ spans items hash item said "
    "votes _host winners templates other path template component component_id cluster distance"
).split()


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture
def named(docs):
    """Documents with all those columns, each with a value of its own."""

    def make(rows):
        frame = docs(*rows, extra=False)
        taken = set(frame.columns)
        return frame.select("*", *(F.lit(f"own {c}").alias(c) for c in NAMES if c not in taken))

    return make


def untouched(frame, left, changed=()):
    assert left.columns == frame.columns
    for row in left.collect():
        assert all(row[c] == f"own {c}" for c in NAMES if c in left.columns and c not in changed)


def test_rows_are_returned_whole(spark, named):
    text = "one two three four five six seven eight nine ten eleven twelve. " * 6
    rows = [*ODD, (30, text), (31, text), (32, f"{text} more")]
    frame = named(rows)
    untouched(frame, clean_lines(frame).drop("quality"))
    untouched(frame, jaccard.one_of_each(frame))
    for more in ({"source": 1.0, "topic": 0.5}, {"lang": 0.5, "tokens": 1.0}):
        mixed = sample_mix(frame, more, queries.words_in(), topic=F.lit(1), share=0.9, rounds=3)
        untouched(frame, mixed.drop("mixing"))
    benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
    for bound in (10**6, 1):
        untouched(frame, remove_leaks(frame, benchmark, broadcast_windows=bound))
    labels = spark.createDataFrame([(30, 1), (31, 0)], "doc_id long, toxic int")
    untouched(frame, remove_toxic(frame, train(frame, labels)))


def test_results_do_not_depend_on_other_columns(spark, docs, named):
    rows = [*ODD, (30, "a b c d e f g h"), (31, "a b c d e f g h"), (32, None)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    labels = spark.createDataFrame([(30, 1), (31, 0)], "doc_id long, toxic int")
    for operator in (
        fingerprint_report,
        lambda d: jaccard.jaccard_components(d, 3, 90),
        lambda d: backoff_scores(d, 3),
        lambda d: count_tokens(d, path, 1024),
        lambda d: leak_report(d, benchmark),
        lambda d: score_toxicity(d, train(d, labels)).select("doc_id", "score", "predicted"),
    ):
        assert sort(operator(named(rows)).collect()) == sort(operator(docs(*rows, extra=False)).collect())
    packed = packing.pack_documents(named(rows), path, packing.Capacity(tokens=64))
    assert packed.count() >= len(rows)


def test_pieces_with_any_names(spark):
    pieces = spark.range(20).select(F.lit(5).cast("long").alias("length"), *(F.lit(c).alias(c) for c in NAMES if c != "length"))
    packed = packing.pack(pieces, packing.Capacity(tokens=10)).collect()
    assert len(packed) == 20 and all(r["offset"] in (0, 5) and r["group"] == "group" for r in packed)


def test_vectors_and_pages_with_any_names(spark):
    vectors = spark.range(40).select(
        F.col("id").alias("vec_id"),
        F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(i * (F.col("id") + 1)).cast("float")).alias("embedding"),
        *(F.lit(c).alias(c) for c in NAMES),
    )
    plain = vectors.select("vec_id", "embedding")
    assert sort(cluster_vectors(vectors).collect()) == sort(cluster_vectors(plain).collect())
    assert whiten_vectors(vectors).count() == whiten_vectors(plain).count() > 0
    pages = spark.createDataFrame([(1, "http://a/", "<p>x y</p>")], "page_id long, url string, html string")
    named = pages.select("*", *(F.lit(c).alias(c) for c in NAMES))
    assert sort(extract_pages(named).collect()) == sort(extract_pages(pages).collect())


def test_full_cells_are_made_up_for_by_others(docs, spark):
    """The expected share is met although one cell is taken whole."""
    frame = docs(*((i, "w " * 10) for i in range(400)), extra=False)
    frame = frame.withColumn("source", F.when(F.col("doc_id") < 20, "small").otherwise("large"))
    mixed = sample_mix(frame, {"source": 0.0}, queries.words_in(), share=0.5)
    rows = mixed.select("source", "mixing.*").collect()
    assert {r["probability"] for r in rows if r["source"] == "small"} == {1.0}
    assert sum(r["probability"] * r["tokens"] for r in rows) == pytest.approx(0.5 * sum(r["tokens"] for r in rows))
    assert len([r for r in rows if r["source"] == "small" and r["sampled"]]) == 20
