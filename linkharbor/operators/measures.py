"""Measures and topic queries over the marts.

A measure is an aggregate over a column with optional equality filters; a topic is a base table
with the tables it may join. A query names fields, filters, sorts and a limit and becomes one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkharbor.config import sql_text

COUNT, COUNT_DISTINCT, SUM, AVERAGE, MAX = "count", "count_distinct", "sum", "average", "max"

_AGGREGATES = {
    COUNT: "count({})",
    COUNT_DISTINCT: "count(distinct {})",
    SUM: "sum({})",
    AVERAGE: "avg({})",
    MAX: "max({})",
}


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    column: str | None = None
    filters: tuple[tuple[str, object], ...] = ()

    def aggregate(self) -> Column:
        value = self.column or "1"
        if self.filters:
            value = f"if({equal_to(self.filters)}, {value}, null)"
        if self.kind not in _AGGREGATES:
            raise ValueError(f"unknown aggregate {self.kind!r}")
        return F.expr(f"{_AGGREGATES[self.kind].format(value)} as {self.name}")


@dataclass(frozen=True)
class Join:
    """Many-to-one left join to a table whose key is unique."""

    table: str
    on: tuple[str, str]  # column of the base table, key of the joined table


@dataclass(frozen=True)
class Topic:
    name: str
    base: str
    default_limit: int
    joins: tuple[Join, ...] = ()


@dataclass(frozen=True)
class Query:
    topic: str
    fields: tuple[str, ...]
    filters: tuple[tuple[str, object], ...] = ()
    sorts: tuple[tuple[str, bool], ...] = ()  # (field, descending)
    limit: int | None = None
    tie_break: tuple[str, ...] = field(default=())


MEASURES: dict[str, tuple[Measure, ...]] = {
    "dim_companies": (Measure("company_count", COUNT_DISTINCT, "company"),),
    "fct_backlinks": (
        Measure("backlink_rows", COUNT),
        Measure("referring_domains", COUNT_DISTINCT, "referring_domain"),
        Measure(
            "high_authority_referring_domains",
            COUNT_DISTINCT,
            "referring_domain",
            (("source_high_authority_flag", True),),
        ),
        Measure("total_edge_weight", SUM, "total_edge_weight"),
    ),
    "fct_backlink_opportunities": (
        Measure("opportunity_count", COUNT),
        *(
            Measure(name, COUNT, None, (("opportunity_tier", tier),))
            for name, tier in (
                ("tier_1_opportunities", "tier_1"),
                ("tier_2_opportunities", "tier_2"),
                ("tier_3_opportunities", "tier_3"),
                ("monitor_opportunities", "monitor"),
            )
        ),
        Measure("high_authority_opportunities", COUNT, None, (("source_high_authority_flag", True),)),
        Measure("average_opportunity_score", AVERAGE, "opportunity_score"),
        Measure("max_opportunity_score", MAX, "opportunity_score"),
    ),
    "mart_company_backlink_summary": (
        Measure("company_rows", COUNT),
        Measure("referring_domains", SUM, "referring_domain_count"),
        Measure("high_authority_referring_domains", SUM, "high_authority_referring_domain_count"),
        Measure("average_backlink_strength_proxy", AVERAGE, "backlink_strength_proxy"),
        Measure("max_backlink_strength_proxy", MAX, "backlink_strength_proxy"),
    ),
    "mart_competitor_overlap": (
        Measure("competitor_rows", COUNT),
        Measure("competitor_referring_domains", SUM, "competitor_referring_domain_count"),
        Measure("overlap_domains", SUM, "overlap_domain_count"),
        Measure("competitor_only_domains", SUM, "competitor_only_domain_count"),
        Measure("average_jaccard_overlap", AVERAGE, "jaccard_overlap"),
    ),
}

COMPANY_JOINS: dict[str, Join] = {
    "fct_backlinks": Join("dim_companies", ("target_company", "company")),
    "mart_company_backlink_summary": Join("dim_companies", ("target_company", "company")),
    "mart_competitor_overlap": Join("dim_companies", ("competitor_company", "company")),
}

TOPICS: dict[str, Topic] = {
    "backlink_opportunities": Topic("backlink_opportunities", "fct_backlink_opportunities", 500),
    "company_backlink_summary": Topic(
        "company_backlink_summary",
        "mart_company_backlink_summary",
        100,
        (COMPANY_JOINS["mart_company_backlink_summary"],),
    ),
    "competitor_overlap": Topic(
        "competitor_overlap",
        "mart_competitor_overlap",
        100,
        (COMPANY_JOINS["mart_competitor_overlap"],),
    ),
}


def equal_to(filters: Sequence[tuple[str, object]]) -> str:
    return " and ".join(f"{name} = {sql_text(value)}" for name, value in filters)


def measure(df: DataFrame, table: str, *names: str, by: Sequence[str] = ()) -> DataFrame:
    """The named measures of a table, over all rows or by the given columns."""
    known = {m.name: m for m in MEASURES[table]}
    return df.groupBy(*by).agg(*[known[n].aggregate() for n in names])


def join_companies(df: DataFrame, table: str, companies: DataFrame) -> DataFrame:
    """Add role, segment and domains of the company a row is about, as `company_*` columns."""
    return _join(df, COMPANY_JOINS[table], companies, "company_")


def topic_query(tables: Mapping[str, DataFrame], query: Query) -> DataFrame:
    """Run a query on the marts.

    A field is a column of the base table, a measure of it, or `table.column` of a joined table.
    With a measure among the fields the other fields are what is grouped by. Sorts put nulls last
    and end with the tie-break columns, so that a limited result is the same on every run.
    """
    topic = TOPICS[query.topic]
    df = tables[topic.base]
    for join in topic.joins:
        prefix = f"{join.table}."
        if any(f.startswith(prefix) for f in (*query.fields, *(n for n, _ in query.filters))):
            df = _join(df, join, tables[join.table], prefix)
    if query.filters:
        df = df.filter(equal_to([(_quoted(n), v) for n, v in query.filters]))
    known = {m.name: m for m in MEASURES[topic.base] if m.name not in df.columns}
    asked = [known[f] for f in query.fields if f in known]
    plain = [F.col(_quoted(f)).alias(_plain(f)) for f in query.fields if f not in known]
    if asked:
        df = df.groupBy(*plain).agg(*[m.aggregate() for m in asked])
        df = df.select(*[_plain(f) for f in query.fields])
        order = [*query.sorts, *((c, False) for c in query.tie_break)]
        df = df.orderBy(*[_order(_plain(c), down) for c, down in order]) if order else df
    else:
        order = [*query.sorts, *((c, False) for c in query.tie_break)]
        df = df.orderBy(*[_order(_quoted(c), down) for c, down in order]) if order else df
        df = df.select(*plain)
    return df.limit(topic.default_limit if query.limit is None else query.limit)


def _join(df: DataFrame, join: Join, other: DataFrame, prefix: str) -> DataFrame:
    left, key = join.on
    added = [f"{c} as `{prefix}{c}`" for c in other.columns if c != key]
    return df.join(other.selectExpr(f"{key} as {left}", *added), left, "left").select(
        *df.columns, *[f"`{prefix}{c}`" for c in other.columns if c != key]
    )


def _order(column: str, descending: bool) -> Column:
    return F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)


def _quoted(name: str) -> str:
    return f"`{name}`" if "." in name else name


def _plain(name: str) -> str:
    return name.replace(".", "_")


# The stored queries, by key.
STORED_QUERIES: dict[str, Query] = {
    "q_top_opportunities": Query(
        "backlink_opportunities",
        (
            "opportunity_domain",
            "opportunity_score",
            "opportunity_tier",
            "linked_competitors",
            "competitor_count",
            "source_high_authority_flag",
            "source_domain_rank_bucket",
            "recommended_action",
        ),
        sorts=(("opportunity_score", True),),
        limit=100,
        tie_break=("opportunity_domain", "graph_release_id"),
    ),
    "q_high_authority": Query(
        "backlink_opportunities",
        (
            "opportunity_domain",
            "opportunity_score",
            "opportunity_tier",
            "linked_competitors",
            "competitor_count",
            "source_domain_rank_bucket",
        ),
        filters=(("source_high_authority_flag", True),),
        sorts=(("opportunity_score", True),),
        limit=100,
        tie_break=("opportunity_domain", "graph_release_id"),
    ),
    "q_tier_summary": Query(
        "backlink_opportunities",
        ("opportunity_tier", "opportunity_count", "average_opportunity_score"),
        sorts=(("opportunity_count", True),),
        limit=100,
        tie_break=("opportunity_tier",),
    ),
    "q_company_footprint": Query(
        "company_backlink_summary",
        (
            "target_company",
            "target_segment",
            "referring_domain_count",
            "high_authority_referring_domain_count",
            "backlink_strength_proxy",
        ),
        sorts=(("referring_domain_count", True),),
        limit=100,
        tie_break=("target_company", "graph_release_id"),
    ),
    "q_overlap": Query(
        "competitor_overlap",
        (
            "competitor_company",
            "competitor_segment",
            "overlap_domain_count",
            "competitor_only_domain_count",
            "target_only_domain_count",
            "jaccard_overlap",
        ),
        sorts=(("competitor_only_domain_count", True),),
        limit=100,
        tie_break=("competitor_company", "graph_release_id"),
    ),
}


def stored_query(key: str, target_slug: str) -> Query:
    """A stored query with the columns that carry the target's name filled in."""
    query = STORED_QUERIES[key]
    named = tuple(f"{target_slug}_only_domain_count" if f == "target_only_domain_count" else f for f in query.fields)
    return Query(query.topic, named, query.filters, query.sorts, query.limit, query.tie_break)
