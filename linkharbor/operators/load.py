"""Turn extracted or delivered records into raw tables of one graph release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkharbor.config import sql_list
from linkharbor.functions.ranks import best_bucket, bucket_name, bucket_order
from linkharbor.functions.suffixes import SuffixRules, registered_domain

LINK_KEY = (
    "graph_release_id",
    "source_domain",
    "target_domain",
    "target_company",
    "target_segment",
)


def load_graph_edges(
    edges: DataFrame,
    companies: DataFrame,
    high_authority_buckets: tuple[str, ...],
    loaded_at: Column,
) -> DataFrame:
    """Loader for extracted edges: lower-case names, weight 1 when missing, known buckets only.

    Takes `graph_release_id` and the four edge columns. Untracked targets leave in the map-side
    join; copies of a link merge in the partial aggregate before anything is shuffled.
    """
    cleaned = edges.selectExpr(
        "graph_release_id",
        "lower(source_domain) as source_domain",
        "lower(target_domain) as target_domain",
        "bigint(coalesce(edge_weight, 1)) as edge_weight",
        "source_domain_rank_bucket",
    )
    merged = (
        cleaned.join(_owners(companies), "target_domain")
        .groupBy(*LINK_KEY)
        .agg(
            F.sum("edge_weight").alias("edge_weight"),
            F.expr(f"{best_bucket('source_domain_rank_bucket')} as source_domain_rank_bucket"),
        )
    )
    high = f"coalesce(source_domain_rank_bucket in ({sql_list(high_authority_buckets)}), false)"
    return merged.select(
        *LINK_KEY,
        "edge_weight",
        "source_domain_rank_bucket",
        F.expr(f"{high} as source_high_authority_flag"),
        loaded_at.alias("loaded_at"),
    )


def build_domain_edges(
    edges: DataFrame,
    companies: DataFrame,
    rules: SuffixRules | None,
    high_authority_buckets: tuple[str, ...],
    loaded_at: Column,
    ordered: bool = False,
) -> DataFrame:
    """Loader for delivered edges: names become registered domains, a missing weight stays missing.

    A bucket outside the known list is kept when a link has no better one. Edges whose source
    has no registered domain are left out; `validate_edge_inputs` lists them. Pass no rules when
    the names are registered domains already.
    """
    # The target side first: links to untracked names are gone before the source is looked at.
    tracked = _registered(edges, "target_domain", rules).join(_owners(companies), "target_domain")
    named = _registered(tracked, "source_domain", rules)
    order, high = bucket_order("source_domain_rank_bucket"), sql_list(high_authority_buckets)
    # Numbers per link and bucket first, in the hash aggregate; the text minimum, which sorts, sees
    # the few rows that are left of a link.
    per_bucket = named.groupBy(*LINK_KEY, "source_domain_rank_bucket").agg(
        F.expr("sum(bigint(edge_weight)) as edge_weight")
    )
    merged = per_bucket.groupBy(*LINK_KEY).agg(
        F.expr("sum(edge_weight) as edge_weight"),
        F.expr(f"min({order}) as best"),
        F.expr(f"min(if({order} is null, source_domain_rank_bucket, null)) as other_bucket"),
        F.expr(f"bool_or(coalesce(source_domain_rank_bucket in ({high}), false)) as high"),
    )
    out = merged.select(
        *LINK_KEY,
        "edge_weight",
        F.expr(f"coalesce({bucket_name('best')}, other_bucket) as source_domain_rank_bucket"),
        F.col("high").alias("source_high_authority_flag"),
        loaded_at.alias("loaded_at"),
    )
    return out.orderBy("source_domain", "target_company") if ordered else out


def load_domain_ranks(ranks: DataFrame, loaded_at: Column) -> DataFrame:
    """Loader for rank records: lower-case names, numbers or null, empty bucket as null."""
    return ranks.selectExpr(
        "graph_release_id",
        "rank_entity_type",
        "lower(domain_or_host) as domain_or_host",
        "try_cast(rank_position as int) as rank_position",
        "try_cast(harmonic_centrality as double) as harmonic_centrality",
        "try_cast(pagerank as double) as pagerank",
        "nullif(rank_bucket, '') as rank_bucket",
    ).withColumn("loaded_at", loaded_at)


def _registered(df: DataFrame, column: str, rules: SuffixRules | None) -> DataFrame:
    if rules is None:
        return df
    out = registered_domain(df, column, "__name", rules)
    return out.withColumn(column, F.col("__name")).drop("__name").filter(F.col(column).isNotNull())


def _owners(companies: DataFrame) -> DataFrame:
    """Domain -> company. `companies` is the configured list, broadcast while it is short."""
    return companies.selectExpr(
        "domain as target_domain", "company as target_company", "segment as target_segment"
    )
