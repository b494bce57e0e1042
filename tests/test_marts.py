"""Staging to marts against brute force in Python, on data with one very hot source and company."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from linkharbor.operators import intermediate, marts, quality, sinks, staging
from linkharbor.plans.build_marts import (
    opportunities_plan,
    quality_report,
    raw_marks,
    read_mart,
    read_marts,
    staged_tables,
    write_marts,
)

RAW = (
    "graph_release_id string, source_domain string, target_domain string, target_company string, "
    "target_segment string, edge_weight long, source_domain_rank_bucket string, "
    "source_high_authority_flag boolean, loaded_at timestamp"
)
BUCKETS = ("top_10k", "top_100k", "top_1m", "long_tail")


@pytest.fixture(scope="module")
def raw_rows(companies):
    import datetime

    rng = random.Random(5)
    owners = [(d, c) for c in companies.companies for d in c.domains]
    out = []
    for n in range(3000):
        domain, company = owners[1] if n % 3 == 0 else rng.choice(owners)  # one company holds most links
        source = "hot.com" if n % 3 == 1 else f"s{rng.randrange(200)}.com"  # so does one source
        bucket = rng.choice([None, "odd", *BUCKETS])
        out.append(
            (
                rng.choice(["rel-1", "rel-2"]),
                source.upper() if n % 7 == 0 else source,
                domain,
                company.company,
                company.segment,
                rng.choice([None, 0, 1, 2]),
                bucket,
                bucket in BUCKETS[:2],
                datetime.datetime(2026, 1, 1 + n % 3),
            )
        )
    return out


@pytest.fixture(scope="module")
def raw_edges(spark, raw_rows):
    return spark.createDataFrame(raw_rows, RAW)


@pytest.fixture(scope="module")
def raw_ranks(spark):
    import datetime

    rng = random.Random(6)
    data = []
    for n in range(900):
        name = "hot.com" if n % 3 == 0 else f"s{rng.randrange(150)}.com"
        data.append(
            (
                rng.choice(["rel-1", "rel-2"]),
                rng.choice(["domain", "domain", "host"]),
                rng.choice([name, name.upper()]),
                rng.choice([None, rng.randrange(1, 2_000_000), rng.randrange(1, 5)]),
                rng.random(),
                rng.random(),
                rng.choice([None, *BUCKETS]),
                datetime.datetime(2026, 1, 1 + rng.randrange(3)),
            )
        )
    return spark.createDataFrame(
        data,
        "graph_release_id string, rank_entity_type string, domain_or_host string, rank_position int, "
        "harmonic_centrality double, pagerank double, rank_bucket string, loaded_at timestamp",
    )


def best(buckets):
    known = [b for b in buckets if b in BUCKETS]
    return min(known, key=BUCKETS.index) if known else None


def test_staged_edges(raw_edges, raw_rows):
    groups = defaultdict(list)
    for r in raw_rows:
        groups[(r[0], r[1].lower(), r[3], r[4])].append(r)
    expected = sorted(
        (
            (
                *key,
                ", ".join(sorted({r[2].lower() for r in rs})),
                len(rs),
                sum(1 if r[5] is None else r[5] for r in rs),
                best(r[6] for r in rs),
                any(r[7] for r in rs),
                max(r[8] for r in rs),
            )
            for key, rs in groups.items()
        ),
        key=repr,
    )
    assert rows(staging.stage_domain_edges(raw_edges)) == expected


def test_staged_ranks_and_rollup(raw_ranks, settings):
    groups = defaultdict(list)
    for r in raw_ranks.collect():
        groups[(r[0], r[1], r[2].lower())].append(r)

    def order(r):
        late, centrality, pagerank = -r["loaded_at"].timestamp(), -r["harmonic_centrality"], -r["pagerank"]
        return (r["rank_position"] is None, r["rank_position"] or 0, late, centrality, pagerank)

    expected = {}
    for key, rs in groups.items():
        expected[key] = tuple(min(rs, key=order))[3:]
    staged = staging.stage_domain_ranks(raw_ranks)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in staged.collect()} == expected
    assert staged.count() == len(expected)
    domains = staging.stage_domain_ranks(raw_ranks, "domain")
    grouped = intermediate.domain_rank_rollup(staged, settings.score)
    direct = intermediate.domain_rank_rollup(domains, settings.score, one_row_per_name=True)
    assert rows(grouped) == rows(direct)
    assert direct.count() == sum(k[1] == "domain" for k in expected)


@pytest.fixture(scope="module")
def links(raw_edges, raw_ranks, settings):
    rollup = intermediate.domain_rank_rollup(staging.stage_domain_ranks(raw_ranks), settings.score)
    found = intermediate.referring_domain_company(staging.stage_domain_edges(raw_edges), rollup)
    return found.cache()


def test_links_keep_the_staged_flag_unless_told_otherwise(spark, raw_edges, raw_ranks, links, settings):
    rollup = intermediate.domain_rank_rollup(staging.stage_domain_ranks(raw_ranks), settings.score)
    staged = staging.stage_domain_edges(raw_edges)
    by_rank = intermediate.referring_domain_company(staged, rollup, flag_from_rank=True)
    assert links.count() == staged.count() == by_rank.count()
    flags = "source_high_authority_flag"
    assert links.filter(flags).count() == staged.filter(flags).count()
    widened = by_rank.filter(f"{flags} and source_domain_rank_position <= 100000").count()
    assert widened == by_rank.filter("source_domain_rank_position <= 100000").count()
    no_bucket = "source_domain_rank_bucket is null"
    assert links.filter(no_bucket).count() < staged.filter(no_bucket).count()


def test_matrix(links, companies, settings):
    found = {
        (r["graph_release_id"], r["source_domain"]): r
        for r in intermediate.company_matrix(links, companies, settings.score).collect()
    }
    groups = defaultdict(list)
    for r in links.collect():
        groups[(r["graph_release_id"], r["source_domain"])].append(r)
    assert found.keys() == groups.keys()
    for key, rs in groups.items():
        row, rivals = found[key], [r for r in rs if r["target_company"] != "Own"]
        names = {r["target_company"] for r in rs}
        assert row["links_to_own"] == ("Own" in names)
        assert row["links_to_side_one"] == ("Side One" in names)
        assert row["competitor_count"] == len(rivals)
        assert row["direct_competitor_count"] == sum(r["target_segment"] == "direct_modern_bi" for r in rivals)
        assert row["incumbent_competitor_count"] == sum(r["target_segment"] == "enterprise_incumbent" for r in rs)
        assert row["linked_competitors"] == (", ".join(sorted(r["target_company"] for r in rivals)) or None)
        assert row["competitor_segments"] == (", ".join(sorted({r["target_segment"] for r in rivals})) or None)
        assert row["total_edge_weight"] == sum(r["total_edge_weight"] for r in rs)
        assert row["best_rank_bucket"] == best(r["source_domain_rank_bucket"] for r in rs)
        assert row["source_high_authority_flag"] == any(r["source_high_authority_flag"] for r in rs)


def test_matrix_of_a_changed_configuration(spark, links, companies, settings):
    """Companies that are no longer configured, or moved to another segment, are counted and listed."""
    changed = links.withColumns(
        {
            "target_company": F.expr("if(target_company = 'Far', 'Gone', target_company)"),
            "target_segment": F.expr("if(target_company = 'Near', 'semantic_layer_adjacent', target_segment)"),
        }
    )
    groups = defaultdict(list)
    for r in changed.collect():
        groups[(r["graph_release_id"], r["source_domain"])].append(r)
    found = intermediate.company_matrix(changed, companies, settings.score).collect()
    assert len(found) == len(groups)
    for row in found:
        rs = groups[(row["graph_release_id"], row["source_domain"])]
        rivals = [r for r in rs if r["target_company"] != "Own"]
        assert row["competitor_count"] == len(rivals)
        assert row["links_to_far"] is False
        assert row["links_to_near"] == any(r["target_company"] == "Near" for r in rs)
        assert row["semantic_layer_competitor_count"] == sum(r["target_segment"] == "semantic_layer_adjacent" for r in rs)
        assert row["incumbent_competitor_count"] == sum(r["target_segment"] == "enterprise_incumbent" for r in rs)
        assert row["linked_competitors"] == (", ".join(sorted(r["target_company"] for r in rivals)) or None)
        assert row["competitor_segments"] == (", ".join(sorted({r["target_segment"] for r in rivals})) or None)
    twice = intermediate.company_matrix(links.union(links), companies, settings.score)
    assert {r["competitor_count"] % 2 for r in twice.collect()} == {0}  # listed as often as linked


def test_overlap_and_summary(spark, links, companies, settings):
    held = defaultdict(set)
    high, weight = defaultdict(set), Counter()
    for r in links.collect():
        key = (r["graph_release_id"], r["target_company"])
        held[key].add(r["source_domain"])
        weight[key] += r["total_edge_weight"]
        if r["source_high_authority_flag"]:
            high[key].add(r["source_domain"])
    overlap = intermediate.competitor_overlap(links, companies).collect()
    assert len(overlap) == 2 * len(companies.competitors)
    for r in overlap:
        own = held[(r["graph_release_id"], "Own")]
        theirs = held[(r["graph_release_id"], r["competitor_company"])]
        assert r["competitor_referring_domain_count"] == len(theirs)
        assert r["own_referring_domain_count"] == len(own)
        assert r["overlap_domain_count"] == len(own & theirs)
        assert r["competitor_only_domain_count"] == len(theirs - own)
        assert r["own_only_domain_count"] == len(own - theirs)
        assert r["union_domain_count"] == len(own | theirs)
        assert r["jaccard_overlap"] == len(own & theirs) / len(own | theirs)
    summary = marts.company_summary(links, companies, settings.score).collect()
    assert len(summary) == 2 * len(companies.companies)
    for r in summary:
        release, key = r["graph_release_id"], (r["graph_release_id"], r["target_company"])
        names = [c.company for c in companies.companies]
        shares = (
            len(held[key]) / max(len(held[(release, n)]) for n in names),
            len(high[key]) / max(len(high[(release, n)]) for n in names),
            weight[key] / max(weight[(release, n)] for n in names),
        )
        assert r["referring_domain_count"] == len(held[key])
        assert r["high_authority_referring_domain_count"] == len(high[key])
        assert r["total_edge_weight"] == weight[key]
        assert r["backlink_strength_proxy"] == pytest.approx(45 * shares[0] + 35 * shares[1] + 20 * shares[2], abs=0.0051)


def test_reports_are_dense_and_safe_without_links_to_the_target(spark, companies, settings):
    data = [("r", "a.com", "Far", "enterprise_incumbent", "far.com", 1, 1, None, False, None, None, None, None)]
    schema = (
        "graph_release_id string, source_domain string, target_company string, target_segment string, "
        "target_domains string, raw_edge_rows long, total_edge_weight long, source_domain_rank_bucket string, "
        "source_high_authority_flag boolean, source_domain_rank_position int, "
        "source_domain_harmonic_centrality double, source_domain_pagerank double, loaded_at timestamp"
    )
    links = spark.createDataFrame(data, schema)
    overlap = {r["competitor_company"]: r for r in marts.competitor_overlap_report(links, companies).collect()}
    assert overlap["Near"]["union_domain_count"] == 0
    assert overlap["Near"]["jaccard_overlap"] == 0.0
    assert overlap["Far"]["competitor_only_domain_count"] == 1
    summary = {r["target_company"]: r for r in marts.company_summary(links, companies, settings.score).collect()}
    assert summary["Own"]["backlink_strength_proxy"] == 0.0
    assert summary["Far"]["backlink_strength_proxy"] == 65.0  # no high-authority link anywhere


def test_evidence_examples(spark, settings):
    data = []
    for n in range(400):  # one site holds half of the evidence
        site = "hot.com" if n % 2 else f"s{n % 9}.com"
        data.append(
            (
                site,
                f"https://{site}/{n % 31}",
                f"https://near.com/{n}",
                "Near",
                ["an analytics post", None, "plain", "us vs them"][n % 4],
                [None, "Title"][n % 3 > 0],
            )
        )
    raw = spark.createDataFrame(
        data,
        "source_domain string, source_url string, target_url string, target_company string, "
        "anchor_text string, page_title string",
    ).selectExpr("*", "source_domain as source_host", "'near.com' as target_domain")
    staged = staging.stage_link_evidence(raw)
    found = {r["source_domain"]: r for r in intermediate.evidence_examples(staged, settings.score).collect()}
    groups = defaultdict(list)
    for r in staged.collect():
        groups[r["source_domain"]].append(r)
    words = settings.score.category_words
    for site, rs in groups.items():
        term = [any(w in r["evidence_text"] for w in words) for r in rs]
        top = min(
            zip(rs, term),
            key=lambda p: (
                not p[1], p[0]["page_title"] is None, p[0]["anchor_text"] is None, p[0]["source_url"], p[0]["target_url"]
            ),
        )[0]
        row = found[site]
        assert row["evidence_record_count"] == len(rs)
        assert row["category_match_count"] == sum(term)
        assert row["has_anchor_text"] == any(r["anchor_text"] for r in rs)
        assert (row["example_url"], row["example_target_url"]) == (top["source_url"], top["target_url"])
        assert row["example_anchor_text"] == top["anchor_text"]


@pytest.fixture(scope="module")
def no_evidence(spark):
    from linkharbor.operators.sinks import RAW_EVIDENCE

    return spark.createDataFrame([], RAW_EVIDENCE)


def test_opportunities_written_and_lazy_agree(
    spark, raw_edges, raw_ranks, no_evidence, settings, tmp_path_factory
):
    staged = staged_tables(settings.companies.frame(spark), raw_edges, raw_ranks, no_evidence)
    root = str(tmp_path_factory.mktemp("marts"))
    counts = write_marts(spark, staged, settings, root)
    tables = read_marts(spark, root)
    assert {n: t.count() for n, t in tables.items()} == counts
    lazy = opportunities_plan(staged, settings)
    assert rows(lazy) == rows(tables["fct_backlink_opportunities"].select(*lazy.columns))
    # domains that link to a competitor are those that link to anyone, less those that link to us
    matrix = tables["int_referring_domain_company_matrix"]
    rivals_only = matrix.filter("not links_to_own").count()
    assert counts["fct_backlink_opportunities"] == rivals_only
    assert len(lazy.columns) == 34
    # release names are text, also those that look like numbers
    numbered = lazy.limit(3).withColumn("graph_release_id", F.lit("007"))
    numbered.write.partitionBy("graph_release_id").parquet(f"{root}/numbered")
    assert {r[0] for r in read_mart(spark, root, "numbered").select("graph_release_id").collect()} == {"007"}
    # a table that was not given does not count as checked
    with pytest.raises(ValueError, match="tables to check are missing: .*fct_backlinks"):
        quality_report({"dim_companies": tables["dim_companies"]}, settings)
    # every check holds on these tables and fails on spoiled copies
    named = {"raw_domain_edges": raw_edges, "raw_domain_ranks": raw_ranks} | staged | tables
    report = {(r["table_name"], r["check_name"]): r["failures"] for r in quality_report(named, settings).collect()}
    assert len(report) == sum(len(c) for c in quality.standard_checks("links_to_own").values())
    assert not any(report.values())
    facts = tables["fct_backlinks"]
    spoiled = dict(named)
    spoiled["fct_backlinks"] = facts.union(facts.limit(2)).unionByName(
        facts.limit(1).selectExpr(
            *[c for c in facts.columns if c not in ("target_company", "referring_domain")],
            "'Nobody' as target_company",
            "string(null) as referring_domain",
        )
    )
    spoiled["mart_competitor_overlap"] = tables["mart_competitor_overlap"].selectExpr(
        *[c for c in tables["mart_competitor_overlap"].columns if c != "jaccard_overlap"], "1.5D as jaccard_overlap"
    )
    broken = {
        (r["table_name"], r["check_name"]): r["failures"]
        for r in quality_report(spoiled, settings).collect()
        if r["failures"]
    }
    assert broken == {
        ("fct_backlinks", "not_null(referring_domain)"): 1,
        ("fct_backlinks", "relationships(target_company)"): 1,
        ("fct_backlinks", "unique(graph_release_id, referring_domain, target_company)"): 2,
        ("mart_competitor_overlap", "between(jaccard_overlap)"): 6,
    }


def test_only_changed_releases_are_built(spark, raw_edges, raw_ranks, no_evidence, settings, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "marts")
    paths = [f"{raw}/edges", f"{raw}/ranks", f"{raw}/evidence"]
    for release in ("r1", "r2"):
        sinks.append_raw(raw_edges.withColumn("graph_release_id", F.lit(release)), paths[0])
        sinks.append_raw(raw_ranks.withColumn("graph_release_id", F.lit(release)), paths[1])
    sinks.append_raw(no_evidence, paths[2], sinks.CRAWL)

    def build():
        tables = [sinks.read_raw(spark, p, s) for p, s in zip(paths, (sinks.RAW_EDGES, sinks.RAW_RANKS, sinks.RAW_EVIDENCE))]
        staged = staged_tables(settings.companies.frame(spark), *tables)
        return write_marts(spark, staged, settings, root, raw_marks(spark, paths, settings))

    def files(release):
        found = {}
        for name in ("fct_backlinks", "fct_backlink_opportunities", "mart_company_backlink_summary"):
            df = read_mart(spark, root, name).where(F.col("graph_release_id") == release)
            found[name] = {r[0] for r in df.select("_metadata.file_path").distinct().collect()}
        return found

    first = build()
    assert first["fct_backlinks"] > 0 and build() == {}  # nothing has changed
    before = files("r1"), files("r2")
    weights = {r: t.where(F.col("graph_release_id") == r).agg(F.sum("total_edge_weight")).first()[0]
               for t in [read_mart(spark, root, "fct_backlinks")] for r in ("r1", "r2")}
    heavier = raw_edges.withColumn("graph_release_id", F.lit("r2")).withColumn(
        "edge_weight", F.coalesce("edge_weight", F.lit(1)) * 3
    )
    sinks.replace_release(heavier, paths[0], "r2")
    second = build()
    assert second["fct_backlinks"] * 2 == first["fct_backlinks"]
    assert files("r1") == before[0]
    assert all(not (files("r2")[n] & before[1][n]) for n in before[1])
    facts = read_mart(spark, root, "fct_backlinks")
    assert facts.count() == first["fct_backlinks"]
    now = {r["graph_release_id"]: r["w"] for r in facts.groupBy("graph_release_id").agg(F.sum("total_edge_weight").alias("w")).collect()}
    assert now == {"r1": weights["r1"], "r2": 3 * weights["r2"]}
    # a release that is emptied goes from the marts
    sinks.replace_release(heavier.limit(0), paths[0], "r2")
    sinks.replace_release(raw_ranks.limit(0), paths[1], "r2")
    build()
    assert {r[0] for r in read_mart(spark, root, "fct_backlinks").select("graph_release_id").distinct().collect()} == {"r1"}


def test_single_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), (None, 2)], "k string, v int")
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(quality.failing_unique_combination(df, ("k", "v"))) == [("a", 1), (None, 2)]
    assert rows(quality.failing_unique(df, "k")) == [("a", 2)]
    assert rows(quality.failing_not_null(df, "v")) == [("b", None)]
    assert rows(quality.failing_expression(df, "v > 1")) == [("a", 1), ("a", 1)]
    assert rows(quality.failing_accepted_values(df, "k", ("a",))) == [("b", 1)]
    assert rows(quality.failing_relationships(df, "k", parent, "id")) == [("b",)]


def test_company_dimension(spark, companies):
    found = marts.company_dimension(staging.stage_companies(companies.frame(spark)))
    assert rows(found) == [
        ("Far", "competitor", "enterprise_incumbent", "far.com"),
        ("Near", "competitor", "direct_modern_bi", "near.com, near.io"),
        ("Own", "target", "target", "own.co"),
        ("Side One", "competitor", "direct_modern_bi", "side.com"),
    ]


def test_enrichment_candidates_are_the_best_of_each_release(spark):
    scores = spark.createDataFrame(
        [(r, f"d{n}.net", float(n % 4)) for r in ("a", "b") for n in range(8 if r == "a" else 2)],
        "graph_release_id string, opportunity_domain string, opportunity_score double",
    )
    assert rows(marts.enrichment_candidates(scores, 3)) == [
        ("a", "d2.net", 2.0), ("a", "d3.net", 3.0), ("a", "d7.net", 3.0), ("b", "d0.net", 0.0), ("b", "d1.net", 1.0),
    ]
