"""Marts: company dimension, backlink facts, scored opportunities, company and overlap reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkharbor.config import CompanySet, ScoreSettings, any_word, slug, sql_list, sql_text
from linkharbor.operators.intermediate import competitor_overlap, source_rows
from linkharbor.operators.staging import sorted_names

SIGNALS = (
    "competitor_coverage_signal",
    "authority_signal",
    "segment_relevance_signal",
    "category_relevance_signal",
    "evidence_quality_signal",
    "clean_domain_signal",
)


def company_dimension(staged_companies: DataFrame) -> DataFrame:
    return staged_companies.groupBy("company", "role", "segment").agg(
        F.expr(f"{sorted_names('domain')} as domains")
    )


def backlink_facts(links: DataFrame) -> DataFrame:
    return links.withColumnRenamed("source_domain", "referring_domain")


def select_opportunities(matrix: DataFrame, companies: CompanySet) -> DataFrame:
    """Domains that link to a competitor and not to the target."""
    return matrix.filter(f"competitor_count > 0 and not {companies.target_link_column}")


def enrich_opportunities(opportunities: DataFrame, examples: DataFrame) -> DataFrame:
    """Add page evidence where a domain has some. Evidence has no release: it counts for each."""
    kept = [c for c in examples.columns if c.startswith("example_")]
    return opportunities.join(examples, "source_domain", "left").selectExpr(
        *opportunities.columns,
        "coalesce(evidence_record_count, 0) as evidence_record_count",
        "coalesce(category_match_count, 0) as category_match_count",
        "coalesce(has_page_title, false) as has_page_title",
        "coalesce(has_anchor_text, false) as has_anchor_text",
        "coalesce(has_example_url, false) as has_example_url",
        *kept,
    )


def coverage_signal(score: ScoreSettings) -> str:
    return f"least(double(competitor_count) / {score.full_coverage}D, 1D)"


def authority_signal(score: ScoreSettings, bucket: str = "best_rank_bucket") -> str:
    """The weight of the best bucket, 0 without one."""
    steps = " ".join(f"when {sql_text(name)} then {weight}D" for name, weight in score.authority)
    return f"case {bucket} {steps} else 0D end"


def segment_signal(companies: CompanySet, score: ScoreSettings) -> str:
    """How close the linked competitors are to the target's own market."""

    def any_link(priority: str) -> str:
        columns = [companies.link_column(name) for name in companies.prioritized(priority)]
        return f"({' or '.join(columns)})" if columns else "false"

    def any_segment(*segments: str) -> str:
        return f"({' + '.join(score.segment_column(s) for s in segments)} > 0)"

    steps = (
        (any_link("strong"), 1.0),
        (f"{any_link('secondary')} and {any_segment(score.direct_segment)}", 0.85),
        (any_segment(score.direct_segment, *score.near_segments), 0.75),
        (any_segment(*score.side_segments), 0.5),
        (any_segment(*score.far_segments), 0.25),
    )
    return "case " + " ".join(f"when {test} then {value}D" for test, value in steps) + " else 0D end"


def category_signal(score: ScoreSettings) -> str:
    return f"least(double(category_match_count) / {score.full_category}D, 1D)"


def evidence_signal() -> str:
    """0 without evidence, else .4 and .2 more for each of URL, title and anchor.

    Counted in tenths: sums of binary fractions would miss the exact decimal by a hair.
    """
    parts = "int(has_example_url) + int(has_page_title) + int(has_anchor_text)"
    return f"if(evidence_record_count = 0, 0D, double(4 + 2 * ({parts})) / 10D)"


def clean_signal(score: ScoreSettings, name: str = "source_domain") -> str:
    unwanted = f"({name} in ({sql_list(score.shorteners)}) or {any_word(name, score.spam_words)})"
    return f"if({unwanted}, 0D, if(length({name}) > {score.longest_clean_name}, 0.4D, 1D))"


def signal_values(companies: CompanySet, score: ScoreSettings) -> dict[str, str]:
    values = (
        coverage_signal(score),
        authority_signal(score),
        segment_signal(companies, score),
        category_signal(score),
        evidence_signal(),
        clean_signal(score),
    )
    return dict(zip(SIGNALS, values))


def add_signals(enriched: DataFrame, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    signals = signal_values(companies, score)
    return enriched.selectExpr("*", *[f"{value} as {name}" for name, value in signals.items()])


def opportunity_score(score: ScoreSettings) -> str:
    """Weighted sum of the signals, added left to right, to two decimals.

    Tier bounds are hit exactly, so the order of the terms and the rounding are part of the result.
    """
    points = (
        score.coverage_points,
        score.authority_points,
        score.segment_points,
        score.category_points,
        score.evidence_points,
        score.clean_points,
    )
    return f"round({' + '.join(f'{p} * {signal}' for p, signal in zip(points, SIGNALS))}, 2)"


def opportunity_tier(score: ScoreSettings, value: str = "opportunity_score") -> str:
    steps = " ".join(f"when {value} >= {lowest}D then {sql_text(name)}" for name, lowest in score.tiers)
    return f"case {steps} else {sql_text(score.lowest_tier)} end"


def recommended_action(score: ScoreSettings) -> str:
    """What to do about a domain, by the first kind of page its example text points at."""
    text = "example_evidence_text"
    steps = (  # fixed values: the names of the actions
        (any_word(text, score.comparison_words), "Create comparison content"),
        (any_word(text, score.partner_words), "Partner/integration outreach"),
        (any_word(text, score.community_words), "Community/content outreach"),
        ("(source_high_authority_flag and evidence_record_count = 0)", "Validate with SEO tool"),
    )
    return "case " + " ".join(f"when {t} then {sql_text(a)}" for t, a in steps) + " else 'Review manually' end"


def score_explanation() -> str:
    # The wording of the explanation.
    return (
        "format_string('Links to %d competitor(s): %s. Rank bucket: %s. WAT evidence rows: %d.', "
        "competitor_count, coalesce(linked_competitors, 'none'), coalesce(best_rank_bucket, 'unknown'), "
        "evidence_record_count)"
    )


def score_opportunities(enriched: DataFrame, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    """The opportunity mart from enriched opportunities: signals, score, tier, action and reason."""
    scored = add_signals(enriched, companies, score).selectExpr(
        "*", f"{opportunity_score(score)} as opportunity_score"
    )
    return scored.selectExpr(
        "graph_release_id",
        "source_domain as opportunity_domain",
        f"false as {companies.target_link_column}",
        "linked_competitors",
        "competitor_segments",
        "competitor_count",
        *[column for _, column in score.segment_columns],
        "best_rank_bucket as source_domain_rank_bucket",
        "source_high_authority_flag",
        "source_domain_rank_position",
        "source_domain_harmonic_centrality",
        "source_domain_pagerank",
        "total_edge_weight",
        *SIGNALS,
        "opportunity_score",
        f"{opportunity_tier(score)} as opportunity_tier",
        "example_url",
        "example_target_url",
        "example_target_company",
        "example_page_title",
        "example_anchor_text",
        f"{recommended_action(score)} as recommended_action",
        f"{score_explanation()} as score_explanation",
    )


def backlink_opportunities(
    matrix: DataFrame, examples: DataFrame, companies: CompanySet, score: ScoreSettings
) -> DataFrame:
    chosen = select_opportunities(matrix, companies)
    return score_opportunities(enrich_opportunities(chosen, examples), companies, score)


def summary_from(sources: DataFrame, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    """Footprint and strength of every configured company in every release, zeros included.

    Sums over `source_rows`: one row per release and task before the only shuffle, however many links
    a company has. The dense result and the largest value of each measure are read off that row.
    """
    measures = ("domains", "high", "weight")
    sums = []
    for c in companies.companies:
        name = slug(c.company)
        sums += [
            f"count_if(a_{name} > 0 and source_domain is not null) as domains_{name}",
            f"count_if(h_{name} and source_domain is not null) as high_{name}",
            f"coalesce(sum(w_{name}), 0) as weight_{name}",
        ]
    releases = sources.groupBy("graph_release_id").agg(*[F.expr(x) for x in sums])
    names = [slug(c.company) for c in companies.companies]
    most = [f"array_max(array({', '.join(f'{m}_{n}' for n in names)})) as most_{m}" for m in measures]
    listed = ", ".join(
        f"struct({sql_text(c.company)} as company, {sql_text(c.role)} as role, {sql_text(c.segment)} as segment, "
        + ", ".join(f"{m}_{slug(c.company)} as {m}" for m in measures)
        + ")"
        for c in companies.companies
    )
    dense = releases.selectExpr("graph_release_id", *most, f"inline(array({listed}))")
    shares = dense.selectExpr(
        "*", *[f"coalesce(double({m}) / nullif(most_{m}, 0), 0D) as share_{m}" for m in measures]
    )
    strength = " + ".join(f"{p} * share_{m}" for p, m in zip(score.strength_points, measures))
    return shares.selectExpr(
        "graph_release_id",
        "company as target_company",
        "role",
        "segment as target_segment",
        "domains as referring_domain_count",
        "high as high_authority_referring_domain_count",
        "weight as total_edge_weight",
        "share_domains as normalized_referring_domain_count",
        "share_high as normalized_high_authority_referring_domain_count",
        "share_weight as normalized_edge_depth",
        f"round({strength}, 2) as backlink_strength_proxy",
    )


def company_summary(links: DataFrame, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    return summary_from(source_rows(links, companies), companies, score)


def overlap_report(overlap: DataFrame) -> DataFrame:
    return overlap.withColumn("jaccard_overlap", F.round("jaccard_overlap", 4))


def competitor_overlap_report(links: DataFrame, companies: CompanySet) -> DataFrame:
    return overlap_report(competitor_overlap(links, companies))


def enrichment_candidates(opportunities: DataFrame, limit: int) -> DataFrame:
    """The best-scored domains of each release whose pages are worth reading next."""
    best_first = Window.partitionBy("graph_release_id").orderBy(F.desc("opportunity_score"), "opportunity_domain")
    return (
        opportunities.select("graph_release_id", "opportunity_domain", "opportunity_score")
        .withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") <= limit)
        .drop("place")
    )
