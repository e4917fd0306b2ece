"""Every registered query against its SQL, and the shape of the plans."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from wordloom.plans import check_sql, registered


@pytest.fixture(scope="module")
def database(sample):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sample}/documents.parquet'")
    yield connection
    connection.close()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(registered()) == set(check_sql())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_sql(spark, sample, database, name):
    frame = registered()[name](spark, sample)
    columns = sorted(frame.columns)
    expected = database.execute(check_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    wanted = sorted(tuple(row[i] for i in order) for row in expected.fetchall())
    found = sorted(tuple(row[column] for column in columns) for row in frame.collect())
    assert len(found) > 0
    assert found == wanted


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["word", "cnt"]
    assert registered().keys() <= entry_points.oracle_sql().keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(registered()))
def test_plans_have_no_cross_join_and_no_row_python(spark, sample, name):
    plan = plan_of(registered()[name](spark, sample))
    for word in (
        "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas", "RoundRobin",
    ):
        assert word not in plan


@pytest.mark.parametrize("name", ["cooc_pairs_within_d4", "cooc_pairs_exact_d4"])
def test_a_small_vocabulary_is_applied_before_counting(spark, sample, name):
    plan = plan_of(registered()[name](spark, sample))
    pairs = plan[: plan.index("FileScan")]
    assert pairs.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan
    # below the count: the count's partial aggregate comes first in the printed tree
    assert pairs.index("partial_count") < pairs.index("BroadcastHashJoin")
    # the tokens of a line are split once
    assert pairs.count("split(lower(") == 1


def test_a_large_vocabulary_is_applied_to_counted_pairs(spark, sample):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(registered()["cooc_pairs_all_words_d1"](spark, sample))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    pairs = plan[: plan.index("posexplode")]
    assert pairs.count("SortMergeJoin") == 2
    assert pairs.rindex("SortMergeJoin") < pairs.index("partial_count")


@pytest.mark.parametrize(
    "name", ["word_counts_joined", "document_frequency_joined", "keyed_term_frequency"]
)
def test_words_are_counted_before_they_meet_a_large_list(spark, sample, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(registered()[name](spark, sample))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tokens = plan.index("Generate explode")
    below = plan[plan.rindex("Exchange", 0, tokens) : tokens]
    assert "partial_count" in below or "functions=[]" in below


def test_pairs_of_all_words_are_aggregated_once(spark, sample):
    plan = plan_of(registered()["cooc_pairs_all_words_d1"](spark, sample))
    pairs = plan[: plan.index("posexplode")]
    assert "sum(cnt" not in pairs


def test_stemming_runs_once_per_row_and_stays_below_the_filter(spark, sample):
    plan = plan_of(registered()["top100_terms"](spark, sample))
    assert plan.count("ArrowEvalPython") == 1
    python = plan.index("ArrowEvalPython")
    assert plan.index("length(term") < python
    assert plan.index("Exchange hashpartitioning(term") < python
    assert not re.search(r"Exchange hashpartitioning\(doc_id", plan)


def test_stemming_the_vocabulary_runs_after_the_distinct(spark, sample):
    frame = registered()["stemmed_vocabulary"](spark, sample).filter("length(term) > 2")
    plan = plan_of(frame)
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("HashAggregate")


def test_the_dense_table_shuffles_counts_but_no_zeros(spark, sample):
    """One shuffle of partial counts, one of what a document has of the vocabulary; zeros
    are added after both."""
    plan = plan_of(registered()["term_frequency_dense_by_line"](spark, sample))
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id", plan)) == 2
    assert plan.index("map_zip_with") < plan.index("Exchange hashpartitioning(doc_id")
    assert "SortMergeJoin" not in plan


def test_scoring_whole_documents_shuffles_none_of_them(spark, sample):
    plan = plan_of(registered()["tfidf"](spark, sample))
    assert "Exchange hashpartitioning(doc_id" not in plan
    assert "SortMergeJoin" not in plan
