"""Staging: clean and deduplicate the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkharbor.functions.ranks import bucket_name, bucket_order


def stage_companies(companies: DataFrame) -> DataFrame:
    return companies.select("company", "role", "segment", "domain")


def stage_domain_edges(raw_edges: DataFrame, lower_names: bool = True) -> DataFrame:
    """One row per release, source domain, company and segment.

    Two steps. The first merges copies of a link, map-side before its shuffle, so a source or
    company that holds a large part of all rows shrinks to one row per target domain there. The
    second gathers what is left of a source, at most one row per tracked domain and segment, and
    leaves the result partitioned by release and source: the later joins and groupings by these
    need no shuffle of their own. With `lower_names` off, for edges straight from a loader
    that has lowered them, the first step finds its grouping done and shuffles nothing.
    """
    if lower_names:
        raw_edges = raw_edges.withColumns({c: F.lower(c) for c in ("source_domain", "target_domain")})
    per_target = raw_edges.groupBy(
        "graph_release_id", "source_domain", "target_domain", "target_company", "target_segment"
    ).agg(
        F.expr("count(*) as raw_edge_rows"),
        F.expr("sum(bigint(coalesce(edge_weight, 1))) as total_edge_weight"),
        F.expr(f"min({bucket_order('source_domain_rank_bucket')}) as bucket"),
        F.expr("bool_or(coalesce(source_high_authority_flag, false)) as high"),
        F.expr("max(loaded_at) as loaded_at"),
    )
    return (
        per_target.repartition("graph_release_id", "source_domain")
        .groupBy("graph_release_id", "source_domain", "target_company", "target_segment")
        .agg(
            F.expr(f"{sorted_names('target_domain')} as target_domains"),
            F.expr("sum(raw_edge_rows) as raw_edge_rows"),
            F.expr("sum(total_edge_weight) as total_edge_weight"),
            F.expr(f"{bucket_name('min(bucket)')} as source_domain_rank_bucket"),
            F.expr("bool_or(high) as source_high_authority_flag"),
            F.expr("max(loaded_at) as loaded_at"),
        )
    )


def sorted_names(name: str) -> str:
    """Aggregate: the values of a bounded group, sorted and joined; null when there is none."""
    return f"nullif(array_join(sort_array(collect_list({name})), ', '), '')"


def stage_domain_ranks(raw_ranks: DataFrame, entity_type: str | None = None) -> DataFrame:
    """One row per release, entity type and name: the lowest position, then the latest load.

    Remaining ties are broken by the values themselves so that reruns agree. The filter on the
    row number becomes a group limit that runs before the shuffle, so copies of a name are
    dropped where they are read. With one entity type asked for, the rows come partitioned by
    release and name, as the join with the links wants them.
    """
    keys = ["graph_release_id", "domain_or_host"]
    if entity_type is None:
        keys.append("rank_entity_type")
    else:
        raw_ranks = raw_ranks.filter(F.col("rank_entity_type") == entity_type)
    named = raw_ranks.withColumn("domain_or_host", F.lower("domain_or_host"))
    best_first = Window.partitionBy(*keys).orderBy(
        F.asc_nulls_last("rank_position"),
        F.desc_nulls_last("loaded_at"),
        F.desc_nulls_last("harmonic_centrality"),
        F.desc_nulls_last("pagerank"),
        F.asc_nulls_last("rank_bucket"),
    )
    return (
        named.withColumn("row_number", F.row_number().over(best_first))
        .filter(F.col("row_number") == 1)
        .drop("row_number")
    )


def stage_link_evidence(raw_evidence: DataFrame) -> DataFrame:
    """Lower-case names plus one lower-case text to search: URLs, title and anchor."""
    lowered = {c: F.lower(c) for c in ("source_domain", "source_host", "target_domain")}
    return raw_evidence.withColumns(
        lowered | {"evidence_text": F.expr(evidence_text())}
    )


def evidence_text(prefix: str = "") -> str:
    """The text of a link to search in."""
    columns = ("source_url", "target_url", "page_title", "anchor_text")
    words = ", ".join(f"coalesce({prefix}{c}, '')" for c in columns)
    return f"lower(concat_ws(' ', {words}))"
