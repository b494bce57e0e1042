"""Intermediate tables: links with ranks, one row per linking domain, overlap, best evidence."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkharbor.config import Company, CompanySet, ScoreSettings, any_word, slug, sql_list, sql_text
from linkharbor.functions.ranks import best_bucket, bucket_name, bucket_order
from linkharbor.operators.staging import evidence_text
from linkharbor.session import materialize

LINK_GRAIN = ("graph_release_id", "source_domain")


def domain_rank_rollup(
    staged_ranks: DataFrame, score: ScoreSettings, one_row_per_name: bool = False
) -> DataFrame:
    """Best domain rank per release and domain.

    Staged ranks hold one row per name already; with `one_row_per_name` the grouping, and its
    shuffle, is left out.
    """
    domains = staged_ranks.filter("rank_entity_type = 'domain'").withColumnRenamed(
        "domain_or_host", "source_domain"
    )
    if one_row_per_name:
        best = domains.selectExpr(
            *LINK_GRAIN,
            "rank_position as best_rank_position",
            "harmonic_centrality",
            "pagerank",
            f"{bucket_name(bucket_order('rank_bucket'))} as best_rank_bucket",
        )
    else:
        best = domains.groupBy(*LINK_GRAIN).agg(
            F.min("rank_position").alias("best_rank_position"),
            F.max("harmonic_centrality").alias("harmonic_centrality"),
            F.max("pagerank").alias("pagerank"),
            F.expr(f"{best_bucket('rank_bucket')} as best_rank_bucket"),
        )
    return best.withColumn(
        "high_authority_rank_flag", F.expr(f"best_rank_position <= {score.high_authority_position}")
    )


def referring_domain_company(
    staged_edges: DataFrame, rollup: DataFrame, flag_from_rank: bool = False
) -> DataFrame:
    """Links with the rank of their source.

    The bucket falls back to the rank's bucket. The flag does so only with `flag_from_rank`: as
    staged it is never null, so a plain fallback would never apply.
    """
    ranks = rollup.selectExpr(
        *LINK_GRAIN,
        "best_rank_position as source_domain_rank_position",
        "harmonic_centrality as source_domain_harmonic_centrality",
        "pagerank as source_domain_pagerank",
        "best_rank_bucket",
        "high_authority_rank_flag",
    )
    flag = "source_high_authority_flag"
    if flag_from_rank:
        flag = f"({flag} or coalesce(high_authority_rank_flag, false))"
    return staged_edges.join(ranks, list(LINK_GRAIN), "left").selectExpr(
        *LINK_GRAIN,
        "target_company",
        "target_segment",
        "target_domains",
        "raw_edge_rows",
        "total_edge_weight",
        "coalesce(source_domain_rank_bucket, best_rank_bucket) as source_domain_rank_bucket",
        f"coalesce({flag}, high_authority_rank_flag, false) as source_high_authority_flag",
        "source_domain_rank_position",
        "source_domain_harmonic_centrality",
        "source_domain_pagerank",
        "loaded_at",
    )


def _configured(companies: CompanySet) -> str:
    """True for a link to a configured company in its configured segment; never null."""
    pairs = sql_list(f"{c.company}\n{c.segment}" for c in companies.companies)
    return f"coalesce(concat(target_company, '\n', target_segment) in ({pairs}), false)"


def source_rows(links: DataFrame, companies: CompanySet) -> DataFrame:
    """One row per release and linking domain, with numbers only: matrix, overlap and summary read it.

    Per configured company: links in its segment (n_), in any (a_), whether one has high authority (h_)
    and their weight (w_); x_links counts the links to all others. Numbers stay in the generated hash aggregate, and a group merges map-side.
    """
    aggregates = []
    for c in companies.companies:
        name, is_it = slug(c.company), f"target_company = {sql_text(c.company)}"
        aggregates += [
            f"count_if({is_it} and target_segment = {sql_text(c.segment)}) as n_{name}",
            f"count_if({is_it}) as a_{name}",
            f"coalesce(bool_or({is_it} and source_high_authority_flag), false) as h_{name}",
            f"sum(if({is_it}, total_edge_weight, null)) as w_{name}",
        ]
    aggregates += [
        f"count_if(not {_configured(companies)}) as x_links",
        "sum(total_edge_weight) as total_edge_weight",
        f"{best_bucket('source_domain_rank_bucket')} as best_rank_bucket",
        "bool_or(source_high_authority_flag) as source_high_authority_flag",
        "min(source_domain_rank_position) as source_domain_rank_position",
        "max(source_domain_harmonic_centrality) as source_domain_harmonic_centrality",
        "max(source_domain_pagerank) as source_domain_pagerank",
    ]
    return links.groupBy(*LINK_GRAIN).agg(*[F.expr(a) for a in aggregates])


def strangers(links: DataFrame, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    """Per release and linking domain, its links to companies that are not, or no longer, configured.

    None when edges were loaded with the same configuration. Only these links gather names. Read the
    links again for them only where `source_rows` has counted any: see `has_strangers`.
    """
    rival = f"target_company <> {sql_text(companies.target.company)}"
    aggregates = [
        f"count_if({rival}) as x_count",
        f"collect_list(if({rival}, target_company, null)) as x_names",
        f"collect_set(if({rival}, target_segment, null)) as x_segments",
    ]
    for segment, name in score.segment_columns:
        only_rivals = f"{rival} and " if segment == score.direct_segment else ""
        aggregates.append(f"count_if({only_rivals}target_segment = {sql_text(segment)}) as x_{name}")
    others = links.filter(f"not {_configured(companies)}")
    return others.groupBy(*LINK_GRAIN).agg(*[F.expr(a) for a in aggregates])


def has_strangers(sources: DataFrame) -> bool:
    """Whether written `source_rows` count links to companies that are not configured."""
    return not sources.where("x_links > 0").isEmpty()


def matrix_from(sources: DataFrame, others: DataFrame | None, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    """The matrix from `source_rows` and `strangers` of the same links; None where there are no strangers.

    The link columns come from the configured companies, so the schema is known before the data. A
    company is listed as often as it is linked, whether it is configured or not.
    """

    def total(members: Iterable[Company]) -> str:
        return " + ".join(["0L", *[f"n_{slug(c.company)}" for c in members]])

    rivals = sorted(companies.competitors, key=lambda c: c.company)
    values = {"competitor_count": f"{total(rivals)} + coalesce(x_count, 0)"}
    for segment, name in score.segment_columns:
        members = rivals if segment == score.direct_segment else companies.companies
        values[name] = f"{total(c for c in members if c.segment == segment)} + coalesce(x_{name}, 0)"
    listed = ", ".join(f"array_repeat({sql_text(c.company)}, int(n_{slug(c.company)}))" for c in rivals)
    names = f"flatten(array({', '.join(filter(None, [listed, 'coalesce(x_names, array())']))}))"
    values["linked_competitors"] = f"nullif(array_join(array_sort({names}), ', '), '')"
    segments = ", ".join(
        f"if({total(c for c in rivals if c.segment == segment)} > 0, {sql_text(segment)}, null)"
        for segment in sorted({c.segment for c in rivals})
    )
    found = f"array_union(array_compact(array({segments})), coalesce(x_segments, array()))"
    if not segments:
        found = "coalesce(x_segments, array())"
    values["competitor_segments"] = f"nullif(array_join(array_sort({found}), ', '), '')"
    if others is None:
        none = {"x_names": "cast(array() as array<string>)", "x_segments": "cast(array() as array<string>)"}
        none |= {name: "0L" for name in ("x_count", *[f"x_{name}" for _, name in score.segment_columns])}
        joined = sources.withColumns({name: F.expr(value) for name, value in none.items()}).alias("s")
    else:
        same = [F.col(f"s.{c}").eqNullSafe(F.col(f"x.{c}")) for c in LINK_GRAIN]
        joined = sources.alias("s").join(others.alias("x"), same, "left")
    return joined.selectExpr(
        *[f"s.{c}" for c in LINK_GRAIN],
        *[f"a_{slug(c.company)} > 0 as {companies.link_column(c.company)}" for c in companies.companies],
        *[f"{value} as {name}" for name, value in values.items()],
        "total_edge_weight",
        "best_rank_bucket",
        "source_high_authority_flag",
        "source_domain_rank_position",
        "source_domain_harmonic_centrality",
        "source_domain_pagerank",
    )


def company_matrix(links: DataFrame, companies: CompanySet, score: ScoreSettings) -> DataFrame:
    """One row per release and linking domain. The rows of numbers are written; links are read again only for strangers."""
    sources = materialize(source_rows(links, companies), "source-rows")
    others = strangers(links, companies, score) if has_strangers(sources) else None
    return matrix_from(sources, others, companies, score)


def overlap_from(sources: DataFrame, companies: CompanySet) -> DataFrame:
    """Shared and exclusive linking domains of each competitor and the target, per release.

    Counts over `source_rows`: one row per release and task before the only shuffle. Every configured
    competitor is filled in from that row, with zeros where it has no link.
    """
    own, name = f"a_{slug(companies.target.company)}", slug(companies.target.company)
    counts = [f"count_if({own} > 0) as own"]
    for c in companies.competitors:
        linked = f"a_{slug(c.company)} > 0"
        counts += [
            f"count_if({linked}) as d_{slug(c.company)}",
            f"count_if({linked} and {own} > 0) as s_{slug(c.company)}",
        ]
    releases = sources.groupBy("graph_release_id").agg(*[F.expr(c) for c in counts])
    listed = ", ".join(
        f"struct({sql_text(c.company)} as company, {sql_text(c.segment)} as segment, "
        f"d_{slug(c.company)} as domains, s_{slug(c.company)} as shared)"
        for c in companies.competitors
    )
    return releases.selectExpr("graph_release_id", "own", f"inline(array({listed}))").selectExpr(
        "graph_release_id",
        "company as competitor_company",
        "segment as competitor_segment",
        "domains as competitor_referring_domain_count",
        f"own as {name}_referring_domain_count",
        "shared as overlap_domain_count",
        "domains - shared as competitor_only_domain_count",
        f"own - shared as {name}_only_domain_count",
        "domains + own - shared as union_domain_count",
        "coalesce(double(shared) / nullif(domains + own - shared, 0), 0D) as jaccard_overlap",
    )


def competitor_overlap(links: DataFrame, companies: CompanySet) -> DataFrame:
    return overlap_from(source_rows(links, companies), companies)


def evidence_examples(staged_evidence: DataFrame, score: ScoreSettings) -> DataFrame:
    """Evidence counts and the best row of each linking domain, in one grouping.

    Best: names a category term, has a title, has an anchor; ties go to the smallest URLs, target
    company, title and anchor. The best row is carried as the smallest struct, which merges before
    the shuffle, so a domain with a large part of all evidence costs no more than any other. Its
    evidence text is made again from its parts: carried along, it would double the struct.
    """
    example = ("source_url", "target_url", "target_company", "page_title", "anchor_text")
    term = f"int(coalesce({any_word('evidence_text', score.category_words)}, false))"
    rows = staged_evidence.selectExpr("source_domain", *example, f"{term} as term")
    rank = f"struct(1 - term, page_title is null, anchor_text is null, {', '.join(example)})"
    return (
        rows.groupBy("source_domain")
        .agg(
            F.expr("count(*) as evidence_record_count"),
            F.expr("sum(term) as category_match_count"),
            F.expr("count(page_title) > 0 as has_page_title"),
            F.expr("count(anchor_text) > 0 as has_anchor_text"),
            F.expr("count(source_url) > 0 as has_example_url"),
            F.expr(f"min({rank}) as best"),
        )
        .selectExpr(
            "source_domain",
            "evidence_record_count",
            "category_match_count",
            "has_page_title",
            "has_anchor_text",
            "has_example_url",
            "best.source_url as example_url",
            *[f"best.{c} as example_{c}" for c in example[1:]],
            f"{evidence_text('best.')} as example_evidence_text",
        )
    )
