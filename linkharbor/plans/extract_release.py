"""Extract one release of the link graph into stage tables.

Four joins: targets, edges, sources, ranks. Every stage is a written table, so a lost executor or
a restarted job goes on from the last complete stage instead of reading the edges again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkharbor.config import CompanySet
from linkharbor.operators import extract
from linkharbor.operators.sinks import Stage, StageFolder
from linkharbor.session import broadcast_if_small, shared_folder

STAGES = ("target_vertices", "filtered_edges", "source_vertices", "domain_ranks", "graph_edges")


@dataclass(frozen=True)
class Extraction:
    stages: dict[str, Stage]
    scanned_edges: int

    def frame(self, name: str) -> DataFrame:
        return self.stages[name].frame

    def counts(self) -> dict[str, int]:
        return {"scanned_edges": self.scanned_edges} | {n: self.stages[n].rows for n in STAGES}


def extract_release(
    spark: SparkSession,
    release: str,
    vertices: DataFrame,
    edges: DataFrame | extract.StoredEdges,
    ranks: DataFrame,
    companies: CompanySet,
    root: str | None = None,
) -> Extraction:
    """`vertices`, `edges` and `ranks` are the good rows of the scans, best from Parquet copies.

    Edges stored by target bucket are pruned to the targets' buckets, and their number is that of these
    buckets, taken from the table of rows beside them. An observing node would stop the pruning, so only
    other edges, which are read whole, are counted below the join that cuts them.
    """
    by_bucket = edges if isinstance(edges, extract.StoredEdges) else extract.with_statistics(edges)
    edges = by_bucket.rows if by_bucket else edges
    folder = StageFolder(
        spark,
        root or f"{shared_folder(spark)}/extract",
        release,
        repr(sorted(companies.domains)),
        (vertices, edges, ranks),
    )
    domains = companies.frame(spark).select("domain").distinct()

    targets = folder.stage(
        "target_vertices", lambda: extract.target_vertices(vertices, companies.frame(spark))
    )
    extract.require_all_targets(targets.frame, domains)
    # The stage is written, so its size is a footer count: broadcast below the bound only.
    small_targets = broadcast_if_small(targets.frame)

    def cut() -> tuple[DataFrame, Callable[[], dict[str, int]]]:
        if by_bucket:
            kept = extract.edges_to_targets(edges, small_targets)
            return kept, lambda: {"scanned_edges": by_bucket.scanned(targets.frame)}
        seen = Observation()
        counted = edges.observe(seen, F.count(F.lit(1)).alias("scanned_edges"))
        return extract.edges_to_targets(counted, small_targets), lambda: dict(seen.get)

    kept = folder.stage("filtered_edges", cut)
    sources = folder.stage("source_vertices", lambda: extract.source_vertices(vertices, kept.frame))
    found = folder.stage("domain_ranks", lambda: extract.source_ranks(ranks, sources.frame))
    named = folder.stage(
        "graph_edges", lambda: extract.graph_edges(kept.frame, sources.frame, found.frame)
    )
    stages = {s.name: s for s in (targets, kept, sources, found, named)}
    return Extraction(stages, kept.facts["scanned_edges"])
