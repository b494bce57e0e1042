"""Tab-separated web-graph files: vertices, edges and ranks, plain or gzip.

A gzip file is one task however large it is, so convert a release once with `to_parquet`
and run everything else from the Parquet copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.functions.hosts import reverse_labels

BAD_LINE = "bad_line"

_VERTEX = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("reversed_domain", T.StringType()),
        T.StructField("num_hosts", T.IntegerType()),
    ]
)
_EDGE = T.StructType(
    [
        T.StructField("source_node_id", T.LongType()),
        T.StructField("target_node_id", T.LongType()),
    ]
)
_RANK = T.StructType(
    [
        T.StructField("harmonic_position", T.IntegerType()),
        T.StructField("harmonic_value", T.DoubleType()),
        T.StructField("pagerank_position", T.IntegerType()),
        T.StructField("pagerank", T.DoubleType()),
        T.StructField("reversed_domain", T.StringType()),
        T.StructField("num_hosts", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Scan:
    """Good rows and, kept apart, the lines that could not be read as such."""

    rows: DataFrame
    rejected: DataFrame


def scan_vertices(spark: SparkSession, path: str, strict: bool = False) -> Scan:
    valid = "node_id >= 0 and reversed_domain <> '' and num_hosts >= 0"
    return _named(_scan(spark, path, _VERTEX, valid, strict))


def scan_edges(spark: SparkSession, path: str, strict: bool = False) -> Scan:
    return _scan(spark, path, _EDGE, "source_node_id >= 0 and target_node_id >= 0", strict)


def scan_ranks(spark: SparkSession, path: str, strict: bool = False) -> Scan:
    valid = (
        "harmonic_position >= 1 and harmonic_value >= 0 and pagerank_position >= 1 "
        "and pagerank >= 0 and reversed_domain <> '' and num_hosts is not null"
    )
    return _named(_scan(spark, path, _RANK, valid, strict, comment="#"))


def sample_rows(rows: DataFrame, n: int, order_by: str) -> DataFrame:
    """The first n rows by a key; n below 1 is an error. Runs as a top-n, not as a full sort."""
    if n < 1:
        raise ValueError("the sample size must be at least 1")
    return rows.orderBy(F.asc_nulls_last(order_by)).limit(n)


def to_parquet(rows: DataFrame, path: str, sort_by: str, rows_per_file: int = 5_000_000) -> None:
    """One-off conversion. Range-sorted files let later id and name filters skip row groups."""
    (
        rows.repartitionByRange(sort_by)
        .sortWithinPartitions(sort_by)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def _scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    valid: str,
    strict: bool,
    comment: str | None = None,
) -> Scan:
    reader = spark.read.option("sep", "\t").option("quote", "").option("escape", "")
    if comment:
        reader = reader.option("comment", comment)
    kept = T.StructType(schema.fields + [T.StructField(BAD_LINE, T.StringType())])
    rows = (
        reader.schema(kept)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )
    # `valid` reads every column, so column pruning cannot hide a broken field.
    good = f"({BAD_LINE} is null and coalesce({valid}, false))"
    cells = ", ".join(f"coalesce(string({name}), '')" for name in schema.names)
    line = f"coalesce({BAD_LINE}, concat_ws('\t', {cells}))"
    if strict:
        rows = rows.filter(
            f"if({good}, true, raise_error(concat('cannot read the web-graph line: ', {line})))"
        )
    return Scan(
        rows.filter(good).select(*schema.names),
        rows.filter(f"not {good}").selectExpr(f"{line} as {BAD_LINE}"),
    )


def _named(scan: Scan) -> Scan:
    named = scan.rows.withColumn("domain", F.expr(reverse_labels("reversed_domain")))
    return Scan(named, scan.rejected)
