"""Header CSV files of graph edges, domain ranks and page link evidence.

All columns are read as text and converted by explicit rules, so no second pass infers types.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.config import sql_list, sql_text
from linkharbor.functions.text import clean_text, optional_number, parse_bool

# The column names of the delivered files.
EDGE_COLUMNS = ("source_domain", "target_domain", "edge_weight", "source_domain_rank_bucket")
RANK_COLUMNS = (
    "rank_entity_type",
    "domain_or_host",
    "rank_position",
    "harmonic_centrality",
    "pagerank",
    "rank_bucket",
)
EVIDENCE_COLUMNS = (
    "wat_file_path",
    "warc_record_id",
    "source_url",
    "source_domain",
    "source_host",
    "target_url",
    "target_domain",
    "target_company",
    "anchor_text",
    "rel",
    "is_nofollow",
    "page_title",
    "page_language",
    "http_status",
    "content_type",
)
OPTIONAL_EVIDENCE_TEXT = (
    "warc_record_id",
    "anchor_text",
    "rel",
    "page_title",
    "page_language",
    "content_type",
)
# A file without one of these is refused; the others may be missing.
REQUIRED_EDGE = ("source_domain", "target_domain")
REQUIRED_RANK = ("rank_entity_type", "domain_or_host")
REQUIRED_EVIDENCE = (
    "wat_file_path",
    "source_url",
    "source_domain",
    "source_host",
    "target_url",
    "target_domain",
    "target_company",
)
ENTITY_TYPES = ("domain", "host")
BAD_RECORD = "bad_record"
HEADER_LINES = 1000


@dataclass(frozen=True)
class Records:
    """Well-formed records as text and, kept apart, those with too few or too many fields."""

    rows: DataFrame
    rejected: DataFrame


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...],
    required: tuple[str, ...] = (),
    multiline: bool = False,
    strict: bool = True,
) -> Records:
    """Columns are found by header name in any order; an optional column that is missing reads as null.

    Files of one folder may differ in their headers: they are read in groups of equal header, each
    group in one scan. A header without a required column is an error, and so, with `strict`, is a
    record whose number of fields is not that of its header. `multiline` allows line breaks inside
    quotes, at the price of one task per file.
    """
    rows, rejected = [], []
    for header, files in _files_by_header(spark, path).items():
        missing = [c for c in required if c not in header]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {files[0]}")
        if len({name.lower() for name in header}) < len(header):
            raise ValueError(f"a column name is repeated in {files[0]}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, BAD_RECORD)])
        read = (
            _csv(spark)
            .option("multiLine", multiline)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD)
            .option("columnPruning", False)  # else a broken record goes unseen when few columns are asked for
            .schema(schema)
            .csv(files)
        )
        # Names a column of the file: Spark will not read the marks of broken records alone.
        seen = f"length(coalesce(`{header[0]}`, '')) >= 0"
        if strict:
            problem = f"raise_error(concat('record does not fit its header: ', {BAD_RECORD}))"
            read = read.filter(f"if({BAD_RECORD} is null, {seen}, {problem})")
        good = read.filter(f"{BAD_RECORD} is null and {seen}")
        rows.append(good.select(*[F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in columns]))
        rejected.append(read.filter(f"{BAD_RECORD} is not null and {seen}").select(BAD_RECORD))
    return Records(_union(spark, rows, columns), _union(spark, rejected, (BAD_RECORD,)))


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...],
    required: tuple[str, ...] = (),
    multiline: bool = False,
    strict: bool = True,
) -> DataFrame:
    return scan_csv(spark, path, columns, required, multiline, strict).rows


def _csv(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Header -> files. A file without any line is left out.

    One job with one task per file: it is handed HEADER_LINES lines at a time and stops after the batch
    with the header, so a long file is not read on. A session of its own keeps these settings from the caller's.
    """
    session = spark.newSession()
    for key, value in {
        "spark.sql.files.openCostInBytes": str(1 << 40),  # so that no two files share a task
        "spark.sql.files.maxPartitionBytes": str(1 << 40),
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(HEADER_LINES),
    }.items():
        session.conf.set(key, value)
    lines = session.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    found: dict[tuple[str, ...], list[str]] = {}
    for row in lines.mapInArrow(_first_lines, "file string, header string").orderBy("file").collect():
        names = next(csv.reader([row["header"]]))
        header = tuple(name or f"_c{i}" for i, name in enumerate(names))
        found.setdefault(header, []).append(row["file"])
    return found


def _first_lines(batches):
    """The first line of a file that is not blank. A short last batch is the file's end: the worker is then kept."""
    found = False
    for batch in batches:
        for row in range(0 if found else batch.num_rows):
            if batch.column("value")[row].as_py().strip():
                found = True
                yield pa.RecordBatch.from_arrays(batch.slice(row, 1).columns, names=["file", "header"])
                break
        if found and batch.num_rows == HEADER_LINES:
            return


def _union(spark: SparkSession, parts: list[DataFrame], columns: tuple[str, ...]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reduce(DataFrame.unionByName, parts)


def evidence_to_parquet(spark: SparkSession, path: str, out: str, multiline: bool = True) -> None:
    """One-off conversion of delivered evidence: a CSV file is one task each time, its copy is many."""
    read_text_csv(spark, path, EVIDENCE_COLUMNS, REQUIRED_EVIDENCE, multiline).write.mode("overwrite").parquet(out)


def read_graph_edges(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return typed_graph_edges(read_text_csv(spark, path, EDGE_COLUMNS, REQUIRED_EDGE, strict=strict), strict)


def typed_graph_edges(text: DataFrame, strict: bool = True) -> DataFrame:
    return text.selectExpr(
        "source_domain",
        "target_domain",
        f"{optional_number('edge_weight', 'int', strict)} as edge_weight",
        f"{clean_text('source_domain_rank_bucket')} as source_domain_rank_bucket",
    )


def read_domain_ranks(
    spark: SparkSession, path: str, graph_release_id: str, strict: bool = True
) -> DataFrame:
    text = read_text_csv(spark, path, RANK_COLUMNS, REQUIRED_RANK, strict=strict)
    return typed_domain_ranks(text, graph_release_id, strict)


def typed_domain_ranks(text: DataFrame, graph_release_id: str, strict: bool = True) -> DataFrame:
    kind = "rank_entity_type"
    if strict:
        problem = f"concat('a rank is of a domain or of a host, not of ', coalesce({kind}, 'null'))"
        kind = f"if({kind} in ({sql_list(ENTITY_TYPES)}), {kind}, raise_error({problem}))"
    return text.selectExpr(
        f"{sql_text(graph_release_id)} as graph_release_id",
        f"{kind} as rank_entity_type",
        "domain_or_host",
        *[
            f"{optional_number(name, to_type, strict)} as {name}"
            for name, to_type in (
                ("rank_position", "int"),
                ("harmonic_centrality", "double"),
                ("pagerank", "double"),
            )
        ],
        f"{clean_text('rank_bucket')} as rank_bucket",
    )


def read_evidence(
    spark: SparkSession, path: str, crawl_id: str, strict: bool = True, multiline: bool = True
) -> DataFrame:
    """Without line breaks inside quotes, say `multiline=False`: files are then split over tasks."""
    text = read_text_csv(spark, path, EVIDENCE_COLUMNS, REQUIRED_EVIDENCE, multiline, strict)
    return typed_evidence(text, crawl_id, strict)


def typed_evidence(text: DataFrame, crawl_id: str, strict: bool = True) -> DataFrame:
    typed = {name: clean_text(name) for name in OPTIONAL_EVIDENCE_TEXT} | {
        "is_nofollow": parse_bool("is_nofollow"),
        "http_status": optional_number("http_status", "int", strict),
    }
    return text.selectExpr(
        f"{sql_text(crawl_id)} as crawl_id",
        *[f"{typed.get(name, name)} as {name}" for name in EVIDENCE_COLUMNS],
    )


def read_loose_edges(spark: SparkSession, path: str) -> DataFrame:
    """The loader's view of an edge file: names in lower case, a bad or missing weight counts 1."""
    return loose_edges(read_text_csv(spark, path, EDGE_COLUMNS, REQUIRED_EDGE))


def loose_edges(text: DataFrame) -> DataFrame:
    return text.selectExpr(
        "lower(source_domain) as source_domain",
        "lower(target_domain) as target_domain",
        "coalesce(try_cast(edge_weight as int), 1) as edge_weight",
        "nullif(source_domain_rank_bucket, '') as source_domain_rank_bucket",
    )
