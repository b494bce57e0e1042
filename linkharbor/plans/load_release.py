"""Load records of one release into the raw tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkharbor.config import Settings
from linkharbor.functions.suffixes import SuffixRules
from linkharbor.operators import load, sinks, snapshots, validate
from linkharbor.session import materialize

EDGES, RANKS, EVIDENCE = "raw_domain_edges", "raw_domain_ranks", "raw_link_evidence"


@dataclass(frozen=True)
class LoadCounts:
    domain_edges: int
    domain_ranks: int
    link_evidence: int


def load_extracted(
    spark: SparkSession,
    graph_edges: DataFrame,
    domain_ranks: DataFrame,
    settings: Settings,
    root: str,
    loaded_at: Column,
) -> LoadCounts:
    """Replace a release by what was extracted for it. Evidence is not part of an extraction."""
    release = settings.release.graph_release_id
    edges = load.load_graph_edges(
        graph_edges.withColumn("graph_release_id", F.lit(release)),
        settings.companies.frame(spark),
        settings.release.high_authority_buckets,
        loaded_at,
    )
    ranks = load.load_domain_ranks(
        domain_ranks.withColumn("graph_release_id", F.lit(release)), loaded_at
    )
    # Both are complete before either is seen.
    prepared = [
        sinks.prepare_release(edges, f"{root}/{EDGES}", release),
        sinks.prepare_release(ranks, f"{root}/{RANKS}", release),
    ]
    return LoadCounts(*[snapshots.commit(spark, p, [release]) for p in prepared], 0)


def load_delivered(
    spark: SparkSession,
    graph_edges: DataFrame,
    settings: Settings,
    rules: SuffixRules,
    root: str,
    loaded_at: Column,
    domain_ranks: DataFrame | None = None,
    link_evidence: DataFrame | None = None,
    strict: bool = True,
    load_id: str | None = None,
) -> LoadCounts:
    """Validate and append delivered records; ranks and evidence are optional.

    With `strict` the first bad record stops the load, and no table has changed. Otherwise valid records
    are appended and the rejected ones go, with the rules they break, to a `_rejected` table next to the
    raw one. All tables are written before any is committed. A load with an id is added once: run again,
    it adds what a run that was broken off between two commits has not, and tells the same counts.
    """
    release = settings.release.graph_release_id
    parts: list[tuple[str, str, Callable[[], validate.Checked], Callable[[DataFrame], DataFrame]]] = [
        (
            EDGES,
            sinks.RELEASE,
            lambda: validate.validate_edge_inputs(graph_edges.withColumn("graph_release_id", F.lit(release)), rules),
            lambda rows: load.build_domain_edges(
                rows, settings.companies.frame(spark), None, settings.release.high_authority_buckets, loaded_at
            ),
        )
    ]
    if domain_ranks is not None:
        stamped_ranks = domain_ranks.withColumn("loaded_at", loaded_at)
        parts.append((RANKS, sinks.RELEASE, lambda: validate.validate_ranks(stamped_ranks, rules), lambda rows: rows))
    if link_evidence is not None:
        stamped = link_evidence.withColumn("extracted_at", loaded_at)
        parts.append((EVIDENCE, sinks.CRAWL, lambda: validate.validate_evidence(stamped, rules), lambda rows: rows))

    counts, prepared = dict.fromkeys((EDGES, RANKS, EVIDENCE), 0), []
    for table, partition, check, build in parts:
        path = f"{root}/{table}"
        # The rejected rows are committed before the valid ones, whose commit says that both are done.
        done = snapshots.committed_rows(spark, path, load_id)
        if done is not None:
            counts[table] = done
            continue
        checked = check()
        if not strict:
            checked = validate.Checked(materialize(checked.rows, "checked"))  # read for both halves
            prepared.append((None, snapshots.prepare(checked.rejected, f"{path}_rejected", partition, load_id)))
        rows = checked.strict() if strict else checked.valid
        prepared.append((table, snapshots.prepare(build(rows), path, partition, load_id)))
    for table, written in prepared:
        rows_of = snapshots.commit(spark, written)
        if table:
            counts[table] = rows_of
    return LoadCounts(counts[EDGES], counts[RANKS], counts[EVIDENCE])
