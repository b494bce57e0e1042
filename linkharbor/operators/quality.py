"""Data tests. Each operator returns the rows that fail; a suite reports counts per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkharbor.config import sql_list, sql_text


def failing_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once (nulls are values here)."""
    return df.groupBy(*columns).agg(F.expr("count(*) as n_records")).filter("n_records > 1").drop("n_records")


def failing_expression(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; a null passes."""
    return df.filter(f"not ({expression})")


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(f"{column} is null")


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(f"{column} is not null").groupBy(column).agg(F.expr("count(*) as n_records"))
    return counts.filter("n_records > 1")


def failing_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their number of rows; a null passes."""
    outside = df.filter(f"{column} not in ({sql_list(values)})")
    return outside.groupBy(F.col(column).alias("value")).agg(F.expr("count(*) as n_records"))


def failing_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child values that no parent row has.

    The distinct child values are looked up, not the child rows: a value that holds a large part
    of the table crosses the network once per task.
    """
    values = child.filter(f"{column} is not null").selectExpr(f"{column} as value").distinct()
    return values.join(parent.selectExpr(f"{parent_column} as value"), "value", "left_anti")


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def failing(self) -> str:
        return f"{self.column} is null"


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"accepted_values({self.column})"

    def failing(self) -> str:
        return f"{self.column} not in ({sql_list(self.values)})"


@dataclass(frozen=True)
class Between:
    """lowest <= column <= highest, either bound optional."""

    column: str
    lowest: float | None = None
    highest: float | None = None

    @property
    def name(self) -> str:
        return f"between({self.column})"

    def failing(self) -> str:
        low = [] if self.lowest is None else [f"{self.column} < {self.lowest}"]
        high = [] if self.highest is None else [f"{self.column} > {self.highest}"]
        return " or ".join(low + high)


@dataclass(frozen=True)
class IsFalse:
    column: str

    @property
    def name(self) -> str:
        return f"is_false({self.column})"

    def failing(self) -> str:
        return self.column


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique({', '.join(self.columns)})"

    def failing_rows(self, df: DataFrame) -> DataFrame:
        if len(self.columns) == 1:
            return failing_unique(df, self.columns[0])
        return failing_unique_combination(df, self.columns)


@dataclass(frozen=True)
class References:
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"relationships({self.column})"


RowCheck = NotNull | AcceptedValues | Between | IsFalse
Check = RowCheck | Unique | References


def run_suite(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """One row per check with the number of failures: (table_name, check_name, failures).

    All row checks of a table share one pass over it; uniqueness and references need a grouping
    each. A table that has checks but was not given is an error.
    """
    parents = {c.parent for cs in checks.values() for c in cs if isinstance(c, References)}
    absent = sorted((set(checks) | parents) - set(tables))
    if absent:
        raise ValueError(f"tables to check are missing: {', '.join(absent)}")
    reports: list[DataFrame] = []
    for table, table_checks in checks.items():
        df = tables[table]
        by_row = [c for c in table_checks if not isinstance(c, Unique | References)]
        if by_row:
            reports.append(_row_report(df, table, by_row))
        for check in table_checks:
            if isinstance(check, Unique):
                reports.append(_counted(check.failing_rows(df), table, check.name))
            elif isinstance(check, References):
                failing = failing_relationships(
                    df, check.column, tables[check.parent], check.parent_column
                )
                reports.append(_counted(failing, table, check.name))
    return reduce(DataFrame.unionByName, reports)


def _row_report(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    counted = df.agg(*[F.expr(f"count_if({c.failing()}) as c{i}") for i, c in enumerate(checks)])
    rows = ", ".join(f"struct({sql_text(c.name)} as check_name, c{i} as failures)" for i, c in enumerate(checks))
    return counted.selectExpr(
        f"{sql_text(table)} as table_name", f"inline(array({rows}))"
    )


def _counted(failing: DataFrame, table: str, name: str) -> DataFrame:
    return failing.agg(F.expr("count(*) as failures")).selectExpr(
        f"{sql_text(table)} as table_name", f"{sql_text(name)} as check_name", "failures"
    )


def standard_checks(target_link_column: str) -> dict[str, tuple[Check, ...]]:
    """The checks of every table of the pipeline."""
    roles = ("target", "competitor")
    grain = ("graph_release_id", "source_domain")
    return {
        "raw_domain_edges": tuple(
            NotNull(c)
            for c in (
                "graph_release_id",
                "source_domain",
                "target_company",
                "target_segment",
                "source_high_authority_flag",
            )
        ),
        "raw_domain_ranks": (
            NotNull("graph_release_id"),
            NotNull("rank_entity_type"),
            AcceptedValues("rank_entity_type", ("domain", "host")),
            NotNull("domain_or_host"),
        ),
        "stg_companies": (
            NotNull("company"),
            NotNull("role"),
            NotNull("segment"),
            AcceptedValues("role", roles),
            NotNull("domain"),
            Unique(("domain",)),
        ),
        "stg_domain_edges": (
            NotNull("graph_release_id"),
            NotNull("source_domain"),
            NotNull("target_company"),
            References("target_company", "stg_companies", "company"),
            NotNull("source_high_authority_flag"),
            Unique((*grain, "target_company")),
        ),
        "stg_domain_ranks": (NotNull("graph_release_id"), NotNull("domain_or_host")),
        "int_domain_rank_rollup": (
            NotNull("graph_release_id"),
            NotNull("source_domain"),
            Unique(grain),
        ),
        "int_referring_domain_company": (
            NotNull("graph_release_id"),
            NotNull("source_domain"),
            NotNull("target_company"),
            Unique((*grain, "target_company")),
        ),
        "int_referring_domain_company_matrix": (
            NotNull("graph_release_id"),
            NotNull("source_domain"),
            NotNull("competitor_count"),
            Unique(grain),
        ),
        "int_competitor_overlap": (
            NotNull("competitor_company"),
            NotNull("jaccard_overlap"),
            Between("jaccard_overlap", 0, 1),
        ),
        "dim_companies": (
            NotNull("company"),
            Unique(("company",)),
            AcceptedValues("role", roles),
        ),
        "fct_backlinks": (
            NotNull("graph_release_id"),
            NotNull("referring_domain"),
            NotNull("target_company"),
            References("target_company", "dim_companies", "company"),
            Unique(("graph_release_id", "referring_domain", "target_company")),
        ),
        "fct_backlink_opportunities": (
            NotNull("graph_release_id"),
            NotNull("opportunity_domain"),
            NotNull(target_link_column),
            IsFalse(target_link_column),
            NotNull("competitor_count"),
            Between("competitor_count", 1),
            NotNull("opportunity_score"),
            Between("opportunity_score", 0, 100),
            Unique(("graph_release_id", "opportunity_domain")),
        ),
        "mart_company_backlink_summary": (
            NotNull("target_company"),
            References("target_company", "dim_companies", "company"),
            NotNull("referring_domain_count"),
            Between("referring_domain_count", 0),
            NotNull("high_authority_referring_domain_count"),
            Between("high_authority_referring_domain_count", 0),
            NotNull("backlink_strength_proxy"),
            Between("backlink_strength_proxy", 0, 100),
        ),
        "mart_competitor_overlap": (
            NotNull("competitor_company"),
            References("competitor_company", "dim_companies", "company"),
            NotNull("jaccard_overlap"),
            Between("jaccard_overlap", 0, 1),
        ),
    }
