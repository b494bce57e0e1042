"""From raw tables to marts, as one lazy plan or as written tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.config import Settings
from linkharbor.operators import intermediate, marts, quality, snapshots, staging
from linkharbor.session import materialize

RELEASED = "graph_release_id"

# Tables that are written; staging stays a view of the raw tables.
WRITTEN = (
    "int_domain_rank_rollup",
    "int_referring_domain_company",
    "int_referring_domain_company_matrix",
    "int_competitor_overlap",
    "int_opportunity_evidence_examples",
    "dim_companies",
    "fct_backlinks",
    "fct_backlink_opportunities",
    "mart_company_backlink_summary",
    "mart_competitor_overlap",
)


def staged_tables(
    companies: DataFrame,
    raw_edges: DataFrame,
    raw_ranks: DataFrame,
    raw_evidence: DataFrame,
    lower_edge_names: bool = True,
) -> dict[str, DataFrame]:
    return {
        "stg_companies": staging.stage_companies(companies),
        "stg_domain_edges": staging.stage_domain_edges(raw_edges, lower_edge_names),
        "stg_domain_ranks": staging.stage_domain_ranks(raw_ranks),
        "ranked_domains": staging.stage_domain_ranks(raw_ranks, "domain"),
        "stg_wat_link_evidence": staging.stage_link_evidence(raw_evidence),
    }


def links_plan(staged: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """Staged edges and ranked domains come partitioned by release and name, so this join, the
    matrix and the summary move no link again."""
    rollup = intermediate.domain_rank_rollup(
        staged["ranked_domains"], settings.score, one_row_per_name=True
    )
    return intermediate.referring_domain_company(
        staged["stg_domain_edges"], rollup, settings.flag_from_rank
    )


def opportunities_plan(staged: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """The opportunity mart from staged tables; only one row of numbers per linking domain is written."""
    matrix = intermediate.company_matrix(links_plan(staged, settings), settings.companies, settings.score)
    examples = intermediate.evidence_examples(staged["stg_wat_link_evidence"], settings.score)
    return marts.backlink_opportunities(matrix, examples, settings.companies, settings.score)


MARKS = "release_marks"


def raw_marks(spark: SparkSession, tables: Iterable[str], settings: Settings) -> dict[str, str]:
    """Per release, a mark of what its marts are made from: the versions committed to raw tables, and the settings.

    `tables` are paths of raw tables; versions of one without releases count for every release.
    """
    held: dict[str, list[str]] = {}
    common = [repr(settings)]
    for path in tables:
        found = snapshots.current(spark, path)
        schema = found.schema if found else ""
        for value, versions in found.versions.items() if found else ():
            lines = [f"{path} {v}" for v in versions]
            if value is not None and f'"{RELEASED}"' in schema:
                held.setdefault(value, []).extend(lines)
            else:
                common += lines
    return {r: hashlib.sha256("\n".join([*common, *sorted(lines)]).encode()).hexdigest() for r, lines in held.items()}


def write_marts(
    spark: SparkSession,
    staged: dict[str, DataFrame],
    settings: Settings,
    root: str,
    marks: dict[str, str] | None = None,
) -> dict[str, int]:
    """Write intermediate tables and marts, each read back before it is used again. Returns the rows written.

    The links are shuffled once more, to one row of numbers per linking domain; matrix, overlap and
    summary are read off these rows. With `marks` (see `raw_marks`) only the releases whose mark is not
    that of the last build are computed and put in place of the old ones, and those that have none any
    more go; the files of the others are not touched. Each table changes by one commit, and the marks
    are kept last: a build that was broken off is done again.
    """
    companies, score = settings.companies, settings.score
    counts: dict[str, int] = {}
    known: dict[str, str] = {}
    if marks is not None:
        last = snapshots.read(spark, f"{root}/{MARKS}", None, None)
        known = {r[RELEASED]: r["mark"] for r in last.collect()} if last is not None else {}
        changed = sorted(r for r in marks if known.get(r) != marks[r])
        gone = sorted(known.keys() - marks.keys())
        if not changed and not gone:
            return counts
        of_changed = F.col(RELEASED).isin(changed)
        staged = {n: df.where(of_changed) if RELEASED in df.columns else df for n, df in staged.items()}

    def table(name: str, df: DataFrame) -> DataFrame:
        path, partition = f"{root}/{name}", RELEASED if RELEASED in df.columns else None
        prepared = snapshots.prepare(df, path, partition)
        if marks is None or not partition:
            before = snapshots.current(spark, path)
            replaced = [*before.versions] if before else []
        else:
            replaced = [*changed, *gone]
        counts[name] = snapshots.commit(spark, prepared, replaced)
        return snapshots.read(spark, path, df.schema, partition, prepared.values)

    rollup = table(
        "int_domain_rank_rollup",
        intermediate.domain_rank_rollup(staged["ranked_domains"], score, one_row_per_name=True),
    )
    links = table(
        "int_referring_domain_company",
        intermediate.referring_domain_company(
            staged["stg_domain_edges"], rollup, settings.flag_from_rank
        ),
    )
    sources = materialize(intermediate.source_rows(links, companies), "source-rows")
    matrix = table(
        "int_referring_domain_company_matrix",
        intermediate.matrix_from(
            sources,
            intermediate.strangers(links, companies, score) if intermediate.has_strangers(sources) else None,
            companies,
            score,
        ),
    )
    overlap = table("int_competitor_overlap", intermediate.overlap_from(sources, companies))
    examples = table(
        "int_opportunity_evidence_examples",
        intermediate.evidence_examples(staged["stg_wat_link_evidence"], score),
    )
    table("dim_companies", marts.company_dimension(staged["stg_companies"]))
    table("fct_backlinks", marts.backlink_facts(links))
    table(
        "fct_backlink_opportunities",
        marts.backlink_opportunities(matrix, examples, companies, score),
    )
    table("mart_company_backlink_summary", marts.summary_from(sources, companies, score))
    table("mart_competitor_overlap", marts.overlap_report(overlap))
    kept = spark.createDataFrame(sorted((marks or {}).items()), f"{RELEASED} string, mark string")
    snapshots.commit(spark, snapshots.prepare(kept, f"{root}/{MARKS}", None), [None])
    return counts


def read_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_mart(spark, root, name) for name in WRITTEN}


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart as last committed; in a plain folder of files, the release in the folder names is text."""
    path = f"{root}/{name}"
    found = snapshots.current(spark, path)
    if found is not None:
        return snapshots.read(spark, path, None, RELEASED if f'"{RELEASED}"' in found.schema else None)
    plain = spark.read.parquet(path)
    if RELEASED not in plain.columns:
        return plain
    schema = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == RELEASED else f for f in plain.schema.fields]
    )
    return spark.read.schema(schema).parquet(path)


def quality_report(tables: dict[str, DataFrame], settings: Settings) -> DataFrame:
    checks = quality.standard_checks(settings.companies.target_link_column)
    return quality.run_suite(tables, checks)
