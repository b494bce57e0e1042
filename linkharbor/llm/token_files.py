"""Token ids in compressed files that can be read document by document.

A file is a row of independent zstandard frames, each with its checksum, and a seek table in a
skippable frame at the end (the public seekable layout). The frames hold one stream of little-endian
unsigned 32-bit ids, cut every FRAME_IDS ids; a reader decompresses only the frames that a document
touches. The manifest, a table, says in which file and at which id of its stream a document starts.

Files are named by task attempt and listed by the manifest rows of the attempt that Spark committed,
so a retried or doubled task does no harm. They go to a folder all executors share, through
pyarrow's file systems.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkharbor.llm.common import batch_of, id_and_text, small_batches, staged
from linkharbor.llm.pieces import encoder
from linkharbor.session import new_run_folder

FRAME_IDS = 1 << 16
LEVEL = 1
# Texts are encoded together until they have so many letters or rows.
TEXT_LETTERS = 8 << 20
TEXT_ROWS = 1 << 16

# Fixed values of the seekable layout.
_SKIPPABLE, _SEEKABLE, _HAS_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")

_MANIFEST = pa.schema(
    [("file", pa.string()), ("part", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())]
)
_READ = pa.schema(
    [("part", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _check(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _located(uri: str):
    """File system and path; Hadoop's names of an object store are those pyarrow knows."""
    from pyarrow import fs

    for theirs, ours in (("s3a://", "s3://"), ("s3n://", "s3://")):
        uri = uri.replace(theirs, ours, 1) if uri.startswith(theirs) else uri
    return fs.FileSystem.from_uri(uri)


class TokenWriter:
    """Appends documents' ids to one file."""

    def __init__(self, uri: str):
        import zstandard

        system, path = _located(uri)
        self.out = system.open_output_stream(path, compression=None)  # the name must not choose one
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.table: list[tuple[int, int, int]] = []
        self.waiting = bytearray()
        self.ids = 0

    def append(self, ids: bytes) -> int:
        """Returns the position in the stream, in ids."""
        at, self.ids = self.ids, self.ids + len(ids) // 4
        self.waiting += ids
        while len(self.waiting) >= 4 * FRAME_IDS:
            self._frame(bytes(self.waiting[: 4 * FRAME_IDS]))
            del self.waiting[: 4 * FRAME_IDS]
        return at

    def _frame(self, raw: bytes) -> None:
        packed = self.pack(raw)
        self.out.write(packed)
        self.table.append((len(packed), len(raw), _check(raw)))

    def close(self) -> None:
        if self.waiting:
            self._frame(bytes(self.waiting))
        body = b"".join(_ENTRY.pack(*e) for e in self.table)
        body += _FOOTER.pack(len(self.table), _HAS_CHECKSUMS, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.out.close()


class TokenReader:
    """`ids(at, n)` gives bytes of n ids; frames are decompressed when touched, the last one is kept."""

    def __init__(self, uri: str):
        import zstandard

        system, path = _located(uri)
        self.file = system.open_input_file(path)
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = self.file.size()
        frames, _, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        length = frames * _ENTRY.size
        raw = self.file.read_at(length, size - _FOOTER.size - length)
        table = np.frombuffer(raw, "<u4").reshape(-1, 3).astype(np.int64)
        self.packed_at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.raw_at = np.concatenate([[0], np.cumsum(table[:, 1])])
        self.checks = table[:, 2]
        self.kept: tuple[int, bytes] = (-1, b"")

    def _frame(self, i: int) -> bytes:
        if self.kept[0] != i:
            at, size = int(self.packed_at[i]), int(self.packed_at[i + 1] - self.packed_at[i])
            raw = self.unpack(self.file.read_at(size, at))
            if _check(raw) != self.checks[i]:
                raise ValueError(f"frame {i} does not match its checksum")
            self.kept = (i, raw)
        return self.kept[1]

    def ids(self, at: int, n: int) -> bytes:
        start, end = 4 * at, 4 * (at + n)
        out = []
        i = int(np.searchsorted(self.raw_at, start, "right")) - 1
        while start < end:
            base, stop = int(self.raw_at[i]), int(self.raw_at[i + 1])
            out.append(self._frame(i)[start - base : min(end, stop) - base])
            start, i = stop, i + 1
        return b"".join(out)


@lru_cache(maxsize=2)
def _reader(uri: str) -> TokenReader:
    return TokenReader(uri)


def _gathered(batches):
    """(ids, texts) across batches: many texts at once repeat more of their words."""
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs.append(doc)
            texts.append(text)
            size += len(text)
            if size >= TEXT_LETTERS or len(docs) >= TEXT_ROWS:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def write_token_files(
    df: DataFrame, path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes every whole text, appends `end_id`, writes files in ascending id; returns the manifest.

    Manifest: file, part (files in order), doc_id, at (position in the file's stream), n_tokens.
    A null text is empty and has its end id only. Rows with one id are ordered by their text, null ids
    come first. `folder` must be shared by all executors; by default a new one under spark.checkpoint.dir.
    """
    spark = df.sparkSession
    folder = folder or new_run_folder(spark, "tokens")
    _make_folder(spark, folder)
    end = struct.pack("<I", end_id)

    def run(batches):
        encode, writer, uri = encoder(path).ids_of_texts, None, ""
        part = TaskContext.get().partitionId()
        for docs, texts in _gathered(batches):
            if writer is None:
                uri = f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}.zst"
                writer = TokenWriter(uri)
            found = [], []
            for ids in encode(texts):
                found[0].append(writer.append(ids + end))
                found[1].append(len(ids) // 4 + 1)
            n = len(docs)
            yield batch_of(_MANIFEST, [[uri] * n, [part] * n, docs, *found])
        if writer is not None:
            writer.close()

    rows = small_batches(id_and_text(df, id_col, text_col))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    manifest = ordered.mapInArrow(run, "file string, part long, doc_id long, at long, n_tokens long")
    return staged(manifest, "token-manifest")


def _make_folder(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the files.

    Give any rows of a manifest: only frames that hold them are decompressed. `start` counts all
    documents of the given manifest rows.
    """

    def run(batches):
        for batch in batches:
            files, parts, ids, ats, counts = (batch.column(i).to_pylist() for i in range(5))
            sums = [zlib.crc32(_reader(f).ids(at, n)) for f, at, n in zip(files, ats, counts)]
            yield batch_of(_READ, [parts, ids, ats, counts, sums])

    read = manifest.mapInArrow(run, "part long, doc_id long, at long, n_tokens long, ids_crc32 long")
    # One row per file: as many as there were tasks.
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")
    )
    return read.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
