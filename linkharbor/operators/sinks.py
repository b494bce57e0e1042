"""Writing raw tables and stages, and counting what was written.

Row counts come from `Observation` nodes placed right below a write, in its last stage. Spark
applies a result task's update once however often tasks are retried, so the counts are exact.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkharbor.operators import snapshots
from linkharbor.operators.snapshots import counted_write

RELEASE, CRAWL = "graph_release_id", "crawl_id"

RAW_EDGES = (
    "source_domain string, target_domain string, target_company string, target_segment string, "
    "edge_weight bigint, source_domain_rank_bucket string, source_high_authority_flag boolean, "
    "loaded_at timestamp, graph_release_id string"
)
RAW_RANKS = (
    "rank_entity_type string, domain_or_host string, rank_position int, harmonic_centrality double, "
    "pagerank double, rank_bucket string, loaded_at timestamp, graph_release_id string"
)
RAW_EVIDENCE = (
    "wat_file_path string, warc_record_id string, source_url string, source_domain string, "
    "source_host string, target_url string, target_domain string, target_company string, "
    "anchor_text string, rel string, is_nofollow boolean, page_title string, page_language string, "
    "http_status int, content_type string, extracted_at timestamp, crawl_id string"
)


def append_raw(df: DataFrame, path: str, partition: str = RELEASE, load_id: str | None = None) -> int:
    """Append rows to a raw table; returns the rows written. A load that names itself is added once."""
    done = snapshots.committed_rows(df.sparkSession, path, load_id)
    if done is not None:
        return done
    return snapshots.commit(df.sparkSession, snapshots.prepare(df, path, partition, load_id))


def replace_release(df: DataFrame, path: str, release: str, partition: str = RELEASE) -> int:
    """Put the rows in place of what the table holds for that release; others stay untouched.

    Readers see the old rows until the new ones are complete, and never both. Rows of another release, or
    of none, stop the write before it changes anything; an input without any row empties the release.
    """
    return snapshots.commit(df.sparkSession, prepare_release(df, path, release, partition), [release])


def prepare_release(df: DataFrame, path: str, release: str, partition: str = RELEASE) -> snapshots.Prepared:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", release):
        raise ValueError(f"unsupported release name {release!r}")
    problem = f"raise_error(concat('a row of release ', coalesce({partition}, 'null'), ' is not of {release}'))"
    return snapshots.prepare(df.filter(f"if({partition} <=> '{release}', true, {problem})"), path, partition)


def read_raw(
    spark: SparkSession, path: str, schema: str, missing_ok: bool = False, partition: str | None = None
) -> DataFrame:
    """A raw table with its full schema, as last committed. Only with `missing_ok` does a missing table read as empty.

    Its partition is the last column of the schema, if it is not said otherwise.
    """
    empty = spark.createDataFrame([], schema)
    found = snapshots.read(spark, path, schema, partition or empty.columns[-1])
    if found is not None:
        return found
    if missing_ok and not path_exists(spark, path):
        return empty
    return spark.read.schema(schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system the path names, be it local, HDFS or an object store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return folder.getFileSystem(conf).exists(folder)


def write_table(df: DataFrame, path: str, partition: str | None = None) -> int:
    """Replace a whole table, partitioned by release where it has one; returns the rows written."""

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(partition) if partition else writer).parquet(path)

    return counted_write(df, write)


@dataclass(frozen=True)
class Stage:
    name: str
    rows: int
    frame: DataFrame
    reused: bool
    facts: dict[str, int]


class StageFolder:
    """Stage tables of one release, configuration and set of inputs, kept across runs.

    A stage is its data plus a one-row manifest written last. When the manifest is there, the stage is
    complete and is read instead of built. The folder is named by the configuration and by the input
    files, so changed inputs have another one; a manifest also names the build of the stages it was
    made from, so a stage is built again once an earlier one was.
    """

    def __init__(
        self, spark: SparkSession, root: str, release: str, config: str, inputs: Iterable[DataFrame] = ()
    ) -> None:
        named = [config, *[input_mark(df) for df in inputs]]
        key = hashlib.sha256("\n".join(named).encode("utf-8")).hexdigest()[:16]
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{release}/{key}"
        self.made_from = ""
        self.asked: dict[str, str] = {}

    def stage(self, name: str, build: Callable[[], DataFrame | tuple[DataFrame, Callable[[], dict[str, int]]]]) -> Stage:
        """`build` gives the frame, and may add a function that tells facts seen while it was written."""
        data, manifest = f"{self.path}/{name}/data", f"{self.path}/{name}/manifest"
        known = self._manifest(manifest)
        made_from = self.asked.setdefault(name, self.made_from)
        if known is not None and known["made_from"] == made_from:
            self.made_from = known["build"]
            schema = T.StructType.fromJson(json.loads(known["schema"]))
            frame = self.spark.read.schema(schema).parquet(data)
            return Stage(name, known["rows"], frame, True, json.loads(known["facts"]))
        built = build()
        frame, tell = built if isinstance(built, tuple) else (built, dict)
        rows, facts, mark = write_table(frame, data), tell(), uuid.uuid4().hex
        self.spark.range(1).select(
            F.lit(rows).cast("bigint").alias("rows"),
            F.lit(frame.schema.json()).alias("schema"),
            F.lit(json.dumps(facts)).alias("facts"),
            F.lit(mark).alias("build"),
            F.lit(made_from).alias("made_from"),
        ).coalesce(1).write.mode("overwrite").parquet(manifest)
        self.made_from = mark
        return Stage(name, rows, self.spark.read.schema(frame.schema).parquet(data), False, facts)

    def _manifest(self, path: str):
        if not path_exists(self.spark, path):
            return None
        columns = "rows bigint, schema string, facts string, build string, made_from string"
        return self.spark.read.schema(columns).parquet(path).first()


def input_mark(df: DataFrame) -> str:
    """Mark of path, size and time of every file a frame reads; replaced, added and removed files change it.

    The files are those of the frame's own plan. Spark lists them, in a job where they are many, and adds
    up a checksum in the tasks that does not depend on their order: one row comes back. No file is opened.
    """
    files = df.inputFiles()
    if not files:
        return ""
    # Names are given as URLs, and read as patterns.
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(f)) for f in files]
    listed = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    facts = "path, length, unix_millis(modificationTime)"
    marks = listed.selectExpr("length", f"xxhash64({facts}) as one", f"xxhash64(1, {facts}) as two")
    found = marks.selectExpr("count(*) as n", "sum(length) as size", "bit_xor(one) as one", "bit_xor(two) as two").first()
    return " ".join(str(value) for value in found)
