import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom import operators as O
from wordloom import storage
from wordloom.functions import STOP_WORDS, stripe_text
from wordloom.operators import selection
from wordloom.storage import stored


def values(frame):
    return sorted(tuple(row) for row in frame.collect())


# Words


@pytest.mark.parametrize("as_table", [False, True])
def test_word_count(corpus, words, as_table):
    stop = words("the") if as_table else ["the"]
    frame = corpus(("1", "The cat, the 'cat'"), ("2", "CAT dog"))
    assert values(O.word_count(frame, stop)) == [("'cat'", 1), ("cat", 2), ("dog", 1)]


def test_word_count_with_case_and_without_stop_words(corpus):
    frame = corpus(("1", "The the"))
    assert values(O.word_count(frame, case_sensitive=True)) == [("The", 1), ("the", 1)]
    assert values(O.word_count(frame)) == [("the", 2)]


def test_top_words_breaks_ties_by_word(spark):
    counts = spark.createDataFrame([("c", 2), ("b", 2), ("a", 1), ("d", 9)], "word string, cnt long")
    assert [r.word for r in O.top_words(counts, 2).collect()] == ["d", "b"]


def test_top_terms_leaves_out_short_terms(spark):
    counts = spark.createDataFrame([("ab", 9), ("abd", 5), ("abc", 5)], "term string, df long")
    assert values(O.top_terms(counts, 1)) == [("abc", 5)]


# Co-occurrence


@pytest.mark.parametrize(
    "text, vocabulary, mode, distance, expected",
    [
        (["a b a"], "ab", "exact", 1, [("a", "b", 2), ("b", "a", 2)]),
        (["a b a"], "ab", "exact", 2, [("a", "a", 2)]),
        (["a"], "a", "exact", 0, [("a", "a", 2)]),
        (["a b a"], "ab", "within", 2, [("a", "a", 2), ("a", "b", 2), ("b", "a", 2)]),
        (["a b a"], "ab", "within", 0, []),
        (["a zzz b"], "ab", "within", 1, []),
        (["a", "b"], "ab", "within", 1, []),
        (["(a) b"], "ab", "exact", 1, [("a", "b", 1), ("b", "a", 1)]),
        (["A, B."], "ab", "within", 5, [("a", "b", 1), ("b", "a", 1)]),
        (["", "...", "a"], "ab", "within", 5, []),
    ],
)
def test_cooccurrence_pairs(lines, words, text, vocabulary, mode, distance, expected):
    assert values(O.cooccurrence_pairs(lines(*text), words(*vocabulary), distance, mode)) == expected


def test_cooccurrence_rejects_bad_arguments(lines, words):
    with pytest.raises(ValueError):
        O.cooccurrence_pairs(lines("a"), words("a"), -1, "exact")
    with pytest.raises(ValueError):
        O.cooccurrence_pairs(lines("a"), words("a"), 1, "about")


def test_an_empty_vocabulary_entry_matches_nothing(lines, words):
    assert values(O.cooccurrence_pairs(lines("(a b)"), words("a", ""), 1)) == []


def test_cooccurrence_stripes(lines, words):
    rows = O.cooccurrence_stripes(lines("a b a", "c"), words("a", "b", "c"), 2)
    assert values(rows.select("word", stripe_text("stripe"))) == [("a", "{a=2, b=2}"), ("b", "{a=2}")]


def brute_force(texts, vocabulary, distances):
    counts = Counter()
    for text in texts:
        tokens = text.split()
        for i, word in enumerate(tokens):
            for j, coword in enumerate(tokens):
                if abs(i - j) in distances and i != j and {word, coword} <= vocabulary:
                    counts[word, coword] += 1
    return sorted((w, c, n) for (w, c), n in counts.items())


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_cooccurrence_against_brute_force(spark, lines, words, threshold):
    """One word makes up a third of the text; with and without broadcast joins."""
    draw = random.Random(7)
    texts = [
        " ".join("hot" if draw.random() < 1 / 3 else f"w{draw.randrange(12)}" for _ in range(draw.randrange(40)))
        for _ in range(60)
    ]
    vocabulary = {"hot", *(f"w{n}" for n in range(8))}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        frame, listed = lines(*texts), words(*vocabulary)
        for d in (1, 3, 5):
            exact = values(O.cooccurrence_pairs(frame, listed, d, "exact"))
            assert exact == brute_force(texts, vocabulary, {d})
            within = values(O.cooccurrence_pairs(frame, listed, d))
            assert within == brute_force(texts, vocabulary, set(range(1, d + 1)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_very_long_line(spark, words):
    """Time and memory grow with the length of a line, not with its square."""
    n = 100_000
    text = F.repeat(F.concat(F.lit("a b "), F.substring(F.col("id").cast("string"), 1, 0)), F.lit(n))
    rows = O.cooccurrence_pairs(spark.range(1).select(text.alias("value")), words("a", "b"), 2)
    assert values(rows) == [
        ("a", "a", 2 * (n - 1)), ("a", "b", 2 * n - 1), ("b", "a", 2 * n - 1), ("b", "b", 2 * (n - 1)),
    ]


# Documents


DOCUMENTS = (("1", "cats"), ("1", "cat the"), ("2", "Cat dogs DOG"), ("3", "the"))


@pytest.mark.parametrize("as_table", [False, True])
def test_document_frequency_counts_documents_not_lines(corpus, words, as_table):
    stop = words("the") if as_table else ["the"]
    assert values(O.document_frequency(corpus(*DOCUMENTS), stop)) == [("cat", 2), ("dog", 1)]


def test_document_frequency_of_whole_documents(corpus):
    frame = corpus(("1", "cats\ncat the"), ("2", "Cat dogs DOG"), ("3", "the"), ("4", "12"))
    rows = O.document_frequency(frame, ["the"], assume_unique_ids=True)
    assert values(rows) == [("cat", 2), ("dog", 1)]
    assert values(O.document_frequency(frame)) == [("cat", 2), ("dog", 1), ("the", 2)]


def test_the_stop_list_is_checked_before_stemming(corpus):
    """``thes`` is no stop word, its stem may be one."""
    assert values(O.document_frequency(corpus(("1", "thes the")), ["the"])) == [("the", 1)]
    assert values(O.stem_vocabulary(corpus(("1", "thes the thes")), ["the"])) == [("thes", "the")]


@pytest.mark.parametrize("as_table", [False, True])
def test_term_frequency(corpus, words, as_table):
    stop = words("the") if as_table else ["the"]
    rows = O.term_frequency(corpus(*DOCUMENTS), words("cat", "the"), stop)
    assert values(rows) == [("1", "cat", 2), ("2", "cat", 1)]


def test_term_frequency_dense_has_every_pair(corpus, words):
    rows = O.term_frequency_dense(corpus(*DOCUMENTS, ("4", "")), words("cat", "dog"), ["the"])
    assert values(rows) == [
        ("1", "cat", 2), ("1", "dog", 0), ("2", "cat", 1), ("2", "dog", 2),
        ("3", "cat", 0), ("3", "dog", 0), ("4", "cat", 0), ("4", "dog", 0),
    ]


def test_counting_within_rows_equals_counting_by_shuffle(corpus, words):
    frame = corpus(("1", "cats cat, dogs"), ("2", "the"), ("3", "dog dog dog Dog's"), ("4", ""))
    for operator in (O.term_frequency, O.term_frequency_dense):
        shuffled = values(operator(frame, words("cat", "dog", "bird"), ["the"]))
        assert values(operator(frame, words("cat", "dog", "bird"), ["the"], True)) == shuffled
        assert shuffled


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("small", [True, False])
def test_a_long_vocabulary_for_the_dense_table(spark, corpus, monkeypatch, unique, small):
    """A million terms, in blocks that are sent to all tasks or shuffled."""
    monkeypatch.setattr(storage, "SMALL", (1 << 30) if small else 0)
    n = 1_000_000
    name = F.concat(F.lit("t"), F.translate("id", "0123456789", "bcdfghjklm"))
    terms = spark.range(n).select(name.alias("term"))
    frame = corpus(("1", "tcb tcb"), ("2", "x"), ("3", "tb"))
    rows = O.term_frequency_dense(frame, terms, assume_unique_ids=unique)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and ("BroadcastHashJoin" in plan) == small
    counted = rows.groupBy("doc_id").agg(F.count("term"), F.count_distinct("term"), F.sum("tf"))
    assert values(counted) == [("1", n, n, 2), ("2", n, n, 0), ("3", n, n, 1)]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("block_terms", [1, 2, 1000])
def test_dense_scores_equal_scores_of_the_dense_table(corpus, words, spark, monkeypatch, small, block_terms):
    monkeypatch.setattr(storage, "SMALL", (1 << 20) if small else 0)
    df = spark.createDataFrame([("cat", 2), ("bird", 5)], "term string, df long")
    vocabulary = words("cat", "dog", "bird", None, "cat")
    frame = corpus(*DOCUMENTS, ("4", ""))
    for total in (10_000, None):
        found = O.dense_scores(
            frame, vocabulary, df, ["the"], total_documents=total, block_terms=block_terms
        )
        table = O.term_frequency_dense(frame, vocabulary, ["the"], block_terms=block_terms)
        assert values(found) == values(O.tfidf(table, df, total))
        assert found.count() == 12
    assert O.dense_scores(frame, words(), df).count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_a_large_list_deals_out_heavy_words_only(spark, monkeypatch, small):
    monkeypatch.setattr(storage, "SMALL", (1 << 20) if small else 0)
    n = 20_000
    every = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("the").alias("word"))
    rare = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("word"))
    rows = stored(every.unionByName(rare))
    heavy = selection.heavy_words(rows, "word", 1 / 64)
    assert [(r["term"], r["parts"]) for r in heavy.collect()] == [("the", 32)]
    listed = rare.filter("doc_id % 2 = 0").select("word").union(spark.sql("select 'the'"))
    kept = selection.keep_vocabulary(rows, listed, spread=F.col("doc_id"))
    assert kept.columns == rows.columns
    assert kept.count() == n + n // 2
    assert selection.remove_stop_words(rows, listed, spread=F.col("doc_id")).count() == n // 2
    if not small:
        # What a task of the join gets: by word and part. No part has more than its share.
        terms = storage.listed(listed).terms
        joined = selection.dealt_join(rows, terms, "word", "left", F.col("doc_id"))
        assert joined.filter("term is null").count() == n // 2
        part = F.pmod(F.xxhash64("doc_id"), F.lit(32))
        most = every.groupBy(part).count().agg(F.max("count")).first()[0]
        assert most < 1.3 * 2 * n / 64


@pytest.mark.parametrize("small", [True, False])
def test_scores_by_a_large_table_of_counts(spark, monkeypatch, small):
    monkeypatch.setattr(storage, "SMALL", (1 << 20) if small else 0)
    tf = spark.range(500).selectExpr("cast(id as string) doc_id", "explode(array('a', 'b', concat('x', id))) term", "2L tf")
    df = spark.createDataFrame([("a", 99), ("x7", 5)], "term string, df long")
    rows = {(r.doc_id, r.term): r.tfidf for r in O.tfidf(tf, df).collect()}
    assert len(rows) == 1500 and rows["7", "a"] == 4.0 and rows["7", "x7"] == 2 * math.log10(10_000 / 6)
    assert rows["8", "x8"] == 2 * math.log10(5000)
    assert {r.tfidf for r in O.tfidf(tf, df, None).filter("term = 'a'").collect()} == {2 * math.log10(5)}


def test_a_vocabulary_of_unknown_size_is_applied_below_the_window(spark, lines):
    """Its size is measured, so that not all pairs of the corpus are counted."""
    frame = lines("a b a a c", "b b", "", "c a")
    unknown = lines("a", "c").join(lines("a", "c", "d"), "value").groupBy("value").count()
    rows = O.cooccurrence_pairs(frame, unknown, 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert values(rows) == brute_force(["a b a a c", "b b", "", "c a"], {"a", "c"}, {1, 2})
    # The printed tree has the last step first: the centre word is tested before its window
    # is unfolded, the other word before pairs are counted.
    assert plan.index("partial_count") < plan.index("BroadcastHashJoin")
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.index("Generate explode") < plan.rindex("BroadcastHashJoin") < plan.index("Generate posexplode")


def test_the_dense_table_takes_a_table_of_stop_words(corpus, words):
    rows = O.term_frequency_dense(corpus(*DOCUMENTS), words("cat", "the"), words("the"))
    assert values(rows) == [
        ("1", "cat", 2), ("1", "the", 0), ("2", "cat", 1), ("2", "the", 0), ("3", "cat", 0), ("3", "the", 0)]


@pytest.mark.parametrize("small", [True, False])
def test_records_of_equal_keys_keep_their_own_maps(corpus, words, monkeypatch, small):
    monkeypatch.setattr(storage, "SMALL", (1 << 20) if small else 0)
    assert values(O.keyed_term_maps(corpus(("1", "a")), words()).select("doc_id", F.size("tf"))) == [("1", 0)]
    frame = corpus(("1", "a b a"), ("1", "a b a"), ("1", "zz"), ("2", ""))
    rows = O.keyed_term_maps(frame, words("a", "b"))
    assert sorted((r.doc_id, sorted(r.tf.items())) for r in rows.collect()) == [
        ("1", []), ("1", [("a", 2), ("b", 1)]), ("1", [("a", 2), ("b", 1)]), ("2", [])]


@pytest.mark.parametrize("mode", ["exact", "within"])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_a_large_vocabulary_gives_the_same_pairs(lines, words, mode, distance):
    frame = lines("a b a a c", "b b", "", "c a")
    rows = [O.cooccurrence_pairs(frame, words("a", "b", "c"), distance, mode, flag) for flag in (False, True)]
    assert values(rows[0]) == values(rows[1])


def test_conflicting_counts_are_an_error(lines):
    from wordloom.sources import term_counts

    assert values(term_counts(lines("a\t1", "a\t1"))) == [("a", 1)]
    with pytest.raises(Exception, match="different counts for a"):
        term_counts(lines("a\t1", "a\t2")).collect()


def test_tfidf(spark):
    tf = spark.createDataFrame(
        [("1", "a", 2), ("1", "b", 1), ("1", "c", 0)], "doc_id string, term string, tf long"
    )
    df = spark.createDataFrame([("a", 99), ("c", 5)], "term string, df long")
    rows = {r.term: r.tfidf for r in O.tfidf(tf, df).collect()}
    assert rows == {"a": 4.0, "b": pytest.approx(math.log10(5000)), "c": 0.0}
    small = {r.term: r.tfidf for r in O.tfidf(tf, df, total_documents=100).collect()}
    assert small["a"] == 0.0


def test_scored_terms(spark, words):
    counts = spark.createDataFrame([("Apple", 3), ("pear", 1)], "term string, df long")
    assert values(O.scored_terms(words("apple", "pear"), counts)) == [("Apple",), ("apple",), ("pear",)]


# Keyed records


def test_keyed_terms(corpus, words):
    keyed = corpus(("d", "b a-a x"), ("d", "a"), ("e", "x_y"))
    vocabulary = words("a", "b")
    assert values(O.keyed_term_frequency(keyed, vocabulary)) == [("d", "a", 3), ("d", "b", 1)]
    maps = O.keyed_term_maps(keyed, vocabulary).select("doc_id", stripe_text("tf"))
    assert values(maps) == [("d", "{a=1}"), ("d", "{a=2, b=1}"), ("e", "{}")]


# Properties of the results on the sample corpus


@pytest.fixture(scope="module")
def sample_pairs(spark, sample):
    from wordloom.plans import registered

    queries = registered()
    return {
        (mode, d): {
            (r.word, r.coword): r.cnt for r in queries[f"cooc_pairs_{mode}_d{d}"](spark, sample).collect()
        }
        for mode in ("exact", "within")
        for d in (1, 2, 3, 4)
    }


def test_pairs_are_symmetric_with_an_even_diagonal(sample_pairs):
    for counts in sample_pairs.values():
        assert all(counts[b, a] == n for (a, b), n in counts.items())
        assert all(n % 2 == 0 for (a, b), n in counts.items() if a == b)


def test_within_is_the_sum_of_exact(sample_pairs):
    total = Counter()
    for d in (1, 2, 3, 4):
        total.update(sample_pairs["exact", d])
        assert dict(total) == sample_pairs["within", d]


def test_stripes_hold_the_same_counts_as_pairs(spark, sample, sample_pairs):
    from wordloom.plans import registered

    rows = registered()["cooc_stripes_d2"](spark, sample).collect()
    parsed = {
        (r.word, part.split("=")[0]): int(part.split("=")[1])
        for r in rows
        for part in r.stripe.strip("{}").split(", ")
    }
    assert parsed == sample_pairs["within", 2]


def test_ranked_lists(spark, sample, sample_pairs):
    from wordloom.plans import registered

    top = registered()["top50_words"](spark, sample).collect()
    assert len(top) == 50 and not {r.word for r in top} & set(STOP_WORDS)
    assert [(-r.cnt, r.word) for r in top] == sorted((-r.cnt, r.word) for r in top)
    assert {w for w, _ in sample_pairs["within", 1]} <= {r.word for r in top}
    terms = registered()["top100_terms"](spark, sample).collect()
    assert [(-r.df, r.term) for r in terms] == sorted((-r.df, r.term) for r in terms)
    assert all(len(r.term) > 2 for r in terms)


def test_a_table_of_stop_words_takes_no_shuffle_of_tokens(spark):
    rows = [(1, "cats cat the the"), (1, "cat dogs"), (None, "cat"), (None, "the dog dog"), (2, "the"), (3, None)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string")
    stop = spark.createDataFrame([("the",), (None,)], "word string")
    vocabulary = spark.createDataFrame([("cat",), ("dog",), ("the",)], "term string")
    df = O.document_frequency(corpus, stop)
    assert {tuple(r) for r in df.collect()} == {("cat", 2), ("dog", 2)}
    # One makes the terms of a document distinct, one counts them.
    assert df._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") <= 4
    tf = {tuple(r) for r in O.term_frequency(corpus, vocabulary, stop).collect()}
    assert tf == {(1, "cat", 3), (1, "dog", 1), (None, "cat", 1), (None, "dog", 2)}
    dense = {tuple(r) for r in O.term_frequency_dense(corpus, vocabulary, stop).collect()}
    ids = (1, None, 2, 3)
    assert dense == {(i, t, n) for i in ids for t in ("cat", "dog", "the") for n in [dict(((a, b), c) for a, b, c in tf).get((i, t), 0)]}
