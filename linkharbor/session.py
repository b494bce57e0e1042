"""Session settings and the shared folder that stage tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Above this many rows, or bytes on disk, a side is joined by shuffle; AQE may still switch at run time.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 16 << 20

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Application id -> folders it has written.
_RUN_FOLDERS: dict[str, list[str]] = {}


def build_session(app: str = "linkharbor", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can write to: the one the cluster names in spark.checkpoint.dir.

    A machine-local folder is only made up in local mode, where driver and executor share a disk.
    """
    context = spark.sparkContext
    configured = (
        spark.conf.get(CHECKPOINT_DIR, None)
        or context.getConf().get(CHECKPOINT_DIR)
        or context.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="linkharbor-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, so reruns never see each other's files.

    It belongs to this application until `delete_run_folders` is called at its end.
    """
    path = f"{shared_folder(spark)}/linkharbor/{name}-{uuid.uuid4().hex}"
    _RUN_FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_run_folders(spark: SparkSession) -> int:
    """Delete what this application wrote under the shared folder; frames read from it end with it."""
    context = spark.sparkContext
    folders = _RUN_FOLDERS.pop(context.applicationId, [])
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and continue from the files (cuts the lineage)."""
    path = new_run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; give it a materialized or config-sized frame."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = size <= MAX_BROADCAST_BYTES and df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
