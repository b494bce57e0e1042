"""A published run's numbers: company sizes go in, its strengths and overlaps must come out."""

from __future__ import annotations

import pytest

from linkharbor.config import Company, CompanySet, ScoreSettings
from linkharbor.operators import marts

# Referring domains, high-authority ones and printed strength of each company,
# then domains shared with the target and printed Jaccard of each competitor.
SIZES = {
    "K1": (40_902, 5_530, 100.00),
    "K2": (2_036, 298, 5.12),
    "K3": (1_647, 228, 4.06),
    "K4": (1_591, 349, 4.74),
    "K5": (999, 160, 2.60),
    "K6": (714, 118, 1.88),
    "K7": (671, 112, 1.78),
    "K8": (416, 82, 1.18),
    "Own": (195, 35, 0.53),
    "K9": (179, 32, 0.49),
    "K10": (145, 25, 0.39),
    "K11": (108, 20, 0.30),
}
SHARED = {
    "K6": (69, 645, 0.0821),
    "K7": (63, 608, 0.0785),
    "K8": (43, 373, 0.0757),
    "K9": (24, 155, 0.0686),
    "K11": (17, 91, 0.0594),
    "K10": (16, 129, 0.0494),
    "K5": (47, 952, 0.0410),
    "K3": (67, 1_580, 0.0377),
    "K2": (64, 1_972, 0.0295),
    "K4": (44, 1_547, 0.0253),
    "K1": (83, 40_819, 0.0020),
}


@pytest.fixture(scope="module")
def published_companies():
    return CompanySet(
        tuple(
            Company(n, "target" if n == "Own" else "competitor", "s", (f"{n.lower()}.com",)) for n in SIZES
        )
    )


@pytest.fixture(scope="module")
def published_links(spark):
    sizes = [(n, s[0], s[1], SHARED.get(n, (s[0],))[0]) for n, s in SIZES.items()]
    companies = spark.createDataFrame(sizes, "target_company string, links int, high int, shared int")
    return companies.selectExpr("*", "explode(sequence(0, links - 1)) as n").selectExpr(
        "'r' as graph_release_id",
        "if(n < shared, concat('own', n), concat(target_company, n)) as source_domain",
        "target_company",
        "n < high as source_high_authority_flag",
        "1L as total_edge_weight",
        "'s' as target_segment",
        "string(null) as source_domain_rank_bucket",
        "int(null) as source_domain_rank_position",
        "double(null) as source_domain_harmonic_centrality",
        "double(null) as source_domain_pagerank",
    )


def test_strength(published_links, published_companies):
    summary = marts.company_summary(published_links, published_companies, ScoreSettings()).collect()
    found = {
        r["target_company"]: (
            r["referring_domain_count"],
            r["high_authority_referring_domain_count"],
            r["backlink_strength_proxy"],
        )
        for r in summary
    }
    assert found == SIZES
    assert sum(r[0] for r in found.values()) == 49_603


def test_overlap(published_links, published_companies):
    overlap = marts.competitor_overlap_report(published_links, published_companies).collect()
    found = {
        r["competitor_company"]: (
            r["overlap_domain_count"],
            r["competitor_only_domain_count"],
            r["jaccard_overlap"],
        )
        for r in overlap
    }
    assert found == SHARED
    assert all(r["own_referring_domain_count"] == 195 for r in overlap)
