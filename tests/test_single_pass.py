"""Queries that work a text out once, by their plans."""

from reviewlake.plans import catalogue

TABLES = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_polarities_are_told_in_one_pass(spark):
    assert plan(catalogue.polarity_union(spark, TABLES)).count("Relation [") == 1


def test_a_vector_is_made_once_for_all_queries(spark):
    told = plan(catalogue.score_relevance(spark, TABLES))
    assert told.index("md5") < told.index("array_max")


def test_terms_are_counted_once(spark):
    assert "regexp_extract_all" not in plan(catalogue.keywords_tfidf(spark, TABLES))
