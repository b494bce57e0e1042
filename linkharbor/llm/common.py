"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkharbor.session import materialize

# An Arrow batch ends at so many rows or bytes, whichever comes first: a Python worker holds one batch at a time.
BATCH_ROWS = 256
BATCH_BYTES = 64 << 20


def remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds of the labelled rows."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns under fixed names, so that no other column of the input can clash; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the rows and bytes handed to Python at once, whatever the session had."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """(ids, texts) of each batch made by id_and_text."""
    for batch in batches:
        yield batch.column(0).to_pylist(), batch.column(1).to_pylist()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a stage to the shared folder and reads on from there; its shuffle files go at once."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(_CLEANUP, before)
