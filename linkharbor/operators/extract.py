"""Cut the tracked part out of the link graph.

The edge table is the only large input that must be read whole. It meets a target table of a
few rows, so it is filtered by a map-side join and only the kept edges are ever shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkharbor.functions.hosts import reverse_labels
from linkharbor.functions.ranks import rank_bucket
from linkharbor.session import materialize

BUCKET = "target_bucket"
EDGE_BUCKETS = 256
FILES_PER_BUCKET = 16


def target_vertices(vertices: DataFrame, domains: DataFrame) -> DataFrame:
    """Vertices of the tracked domains. `domains` has one column `domain`, already normalized."""
    wanted = domains.selectExpr(f"{reverse_labels('domain')} as reversed_domain")
    return vertices.join(wanted, "reversed_domain", "left_semi").select(
        "node_id", "reversed_domain", "domain", "num_hosts"
    )


def missing_targets(found: DataFrame, domains: DataFrame) -> DataFrame:
    return domains.select("domain").distinct().join(found.select("domain"), "domain", "left_anti")


def require_all_targets(found: DataFrame, domains: DataFrame) -> None:
    """Raise with all missing names, sorted, and their number; the names come from the configuration."""
    missing = materialize(missing_targets(found, domains), "missing-targets")
    names = sorted(r["domain"] for r in missing.collect())
    if names:
        raise ValueError(f"{len(names)} target domains missing from the vertices: {names}")


def bucket_of(node_id: str) -> str:
    """Bucket of a node id: edges are stored by it, so that a few targets need a few buckets only."""
    return f"pmod(xxhash64({node_id}), {EDGE_BUCKETS})"


@dataclass(frozen=True)
class StoredEdges:
    """Edges by target bucket, and the number of rows in each bucket."""

    rows: DataFrame
    rows_per_bucket: DataFrame

    def scanned(self, targets: DataFrame) -> int:
        """Edges in the buckets of the targets: those that a pruned scan reads."""
        asked = targets.select(F.expr(f"int({bucket_of('node_id')})").alias(BUCKET)).distinct()
        found = self.rows_per_bucket.join(asked, BUCKET, "left_semi").agg(F.sum("n")).first()
        return int(found[0] or 0)


def store_edges(edges: DataFrame, path: str) -> None:
    """One-off conversion of the edge list to Parquet, a folder for each bucket of target ids.

    A hot target fills its bucket with many files: rows are spread by their source as well. The number of
    rows per bucket goes to a table beside it, read off the footers of the files just written.
    """
    stored = edges.withColumn(BUCKET, F.expr(f"int({bucket_of('target_node_id')})"))
    spread = F.expr(f"pmod(xxhash64(source_node_id), {FILES_PER_BUCKET})")
    stored.repartition(BUCKET, spread).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    back = edges.sparkSession.read.schema(stored.schema).parquet(path)
    _bucket_rows(back).coalesce(1).write.mode("overwrite").parquet(_statistics(path))


def stored_edges(spark: SparkSession, path: str) -> StoredEdges:
    """What `store_edges` wrote."""
    return StoredEdges(spark.read.parquet(path), spark.read.parquet(_statistics(path)))


def with_statistics(edges: DataFrame) -> StoredEdges | None:
    """Edges by target bucket without their table of rows: no column is read to count them."""
    return StoredEdges(edges, _bucket_rows(edges)) if BUCKET in edges.columns else None


def _bucket_rows(edges: DataFrame) -> DataFrame:
    return edges.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))


def _statistics(path: str) -> str:
    return f"{path.rstrip('/')}-rows"


def edges_to_targets(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges that end at a tracked node.

    Edges stored by `store_edges` are joined on their bucket as well: Spark then reads only the
    buckets of the targets, found at run time by dynamic partition pruning.
    """
    names = targets.selectExpr("node_id as target_node_id", "domain as target_domain")
    keys = ["target_node_id"]
    if BUCKET in edges.columns:
        names = names.withColumn(BUCKET, F.expr(f"int({bucket_of('target_node_id')})"))
        # Pruning needs a filter on the small side; every target has a name.
        names = names.filter("target_domain > ''")
        keys.append(BUCKET)
    return edges.join(names, keys).select("source_node_id", "target_node_id", "target_domain")


def source_vertices(vertices: DataFrame, kept_edges: DataFrame) -> DataFrame:
    ids = kept_edges.selectExpr("source_node_id as node_id").distinct()
    return vertices.join(ids, "node_id", "left_semi").select(
        "node_id", "reversed_domain", "domain", "num_hosts"
    )


def source_ranks(ranks: DataFrame, sources: DataFrame) -> DataFrame:
    """Rank records of the linking domains, in the shape the rank loader takes."""
    return ranks.join(sources.select("reversed_domain"), "reversed_domain", "left_semi").selectExpr(
        "'domain' as rank_entity_type",
        "domain as domain_or_host",
        "harmonic_position as rank_position",
        "harmonic_value as harmonic_centrality",
        "pagerank",
        f"{rank_bucket('harmonic_position')} as rank_bucket",
    )


def edge_inputs(kept_edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Named edges of weight 1; an edge with an unknown end is dropped."""
    named_sources = sources.selectExpr("node_id as source_node_id", "domain as source_domain")
    named_targets = targets.selectExpr("node_id as target_node_id", "domain as target_domain")
    return (
        kept_edges.select("source_node_id", "target_node_id")
        .join(named_targets, "target_node_id")
        .join(named_sources, "source_node_id")
        .selectExpr("source_domain", "target_domain", "1 as edge_weight")
    )


def graph_edges(kept_edges: DataFrame, sources: DataFrame, ranks: DataFrame) -> DataFrame:
    """Named edges with the rank bucket of their source, null where it has no rank.

    The bucket joins the sources first, so the kept edges, the larger side by far, are shuffled
    once, by source id, and have their target's name already. A source with a large part of all
    edges is split by AQE. A name listed twice in the ranks counts once, so no edge is doubled.
    """
    buckets = ranks.groupBy(F.col("domain_or_host").alias("domain")).agg(
        F.expr(f"{rank_bucket('min(rank_position)')} as source_domain_rank_bucket")
    )
    named = sources.join(buckets, "domain", "left").selectExpr(
        "node_id as source_node_id", "domain as source_domain", "source_domain_rank_bucket"
    )
    return kept_edges.join(named, "source_node_id").selectExpr(
        "source_domain", "target_domain", "1 as edge_weight", "source_domain_rank_bucket"
    )
