from __future__ import annotations

import pytest

from conftest import rows
from linkharbor.operators import measures
from linkharbor.operators.measures import Measure, Query


@pytest.fixture(scope="module")
def tables(spark):
    opportunities = spark.createDataFrame(
        [("r", f"d{n:03}.com", float(n % 40), ["tier_1", "tier_2"][n % 2], n % 5 == 0) for n in range(600)],
        "graph_release_id string, opportunity_domain string, opportunity_score double, opportunity_tier string, "
        "source_high_authority_flag boolean",
    )
    overlap = spark.createDataFrame(
        [("r", "Near", "s1", 3, 7), ("r", "Far", "s2", 2, 9), ("r", "Gone", "s3", 1, 9)],
        "graph_release_id string, competitor_company string, competitor_segment string, "
        "overlap_domain_count long, competitor_only_domain_count long",
    )
    companies = spark.createDataFrame(
        [("Near", "competitor", "s1", "near.com"), ("Far", "competitor", "s2", "far.com")],
        "company string, role string, segment string, domains string",
    )
    return {
        "fct_backlink_opportunities": opportunities,
        "mart_competitor_overlap": overlap,
        "dim_companies": companies,
    }


def test_measures(tables):
    found = measures.measure(
        tables["fct_backlink_opportunities"],
        "fct_backlink_opportunities",
        "opportunity_count",
        "tier_1_opportunities",
        "tier_3_opportunities",
        "high_authority_opportunities",
        "average_opportunity_score",
        "max_opportunity_score",
    )
    assert rows(found) == [(600, 300, 0, 120, 19.5, 39.0)]
    with pytest.raises(ValueError, match="unknown aggregate"):
        Measure("x", "median", "y").aggregate()


def test_plain_fields_filter_sort_and_tie_break(tables):
    query = Query(
        "backlink_opportunities",
        ("opportunity_domain", "opportunity_score"),
        filters=(("source_high_authority_flag", True),),
        sorts=(("opportunity_score", True),),
        limit=3,
        tie_break=("opportunity_domain",),
    )
    found = [tuple(r) for r in measures.topic_query(tables, query).collect()]
    assert found == [("d035.com", 35.0), ("d075.com", 35.0), ("d115.com", 35.0)]


def test_default_limit_of_the_topic(tables):
    query = Query("backlink_opportunities", ("opportunity_domain",))
    assert measures.topic_query(tables, query).count() == 500


def test_measures_group_by_the_other_fields(tables):
    query = Query(
        "backlink_opportunities",
        ("opportunity_tier", "opportunity_count", "average_opportunity_score"),
        sorts=(("opportunity_count", True),),
        tie_break=("opportunity_tier",),
    )
    found = [tuple(r) for r in measures.topic_query(tables, query).collect()]
    assert found == [("tier_1", 300, 19.0), ("tier_2", 300, 20.0)]


def test_joined_fields_keep_rows_without_a_match(tables):
    query = Query(
        "competitor_overlap",
        ("competitor_company", "dim_companies.domains", "competitor_only_domain_count"),
        sorts=(("competitor_only_domain_count", True),),
        tie_break=("competitor_company",),
    )
    found = [tuple(r) for r in measures.topic_query(tables, query).collect()]
    assert found == [("Far", "far.com", 9), ("Gone", None, 9), ("Near", "near.com", 7)]


def test_join_companies(tables):
    found = measures.join_companies(
        tables["mart_competitor_overlap"], "mart_competitor_overlap", tables["dim_companies"]
    )
    assert rows(found.select("competitor_company", "company_domains")) == [
        ("Far", "far.com"),
        ("Gone", None),
        ("Near", "near.com"),
    ]


def test_stored_query_names_the_target():
    assert "acme_only_domain_count" in measures.stored_query("q_overlap", "acme").fields
    assert measures.stored_query("q_tier_summary", "acme") == measures.STORED_QUERIES["q_tier_summary"]
