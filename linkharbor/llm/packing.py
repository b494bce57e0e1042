"""Packing documents into sequences of at most LIMIT tokens, shortest pack first over the histogram.

Each document's ids are cut every LIMIT ids. Only the histogram of piece lengths, at most LIMIT rows,
reaches the driver. Lengths are placed longest first, each into the shortest packs that still have
room, as counts of packing patterns. The patterns then name, for each length, ranges of ranks; pieces
find their place by their rank among all pieces of their length.
"""

from __future__ import annotations

import heapq
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkharbor.llm.common import batch_of, id_and_text, small_batches, staged
from linkharbor.llm.pieces import encoder

LIMIT = 4096
_RANKS = 1 << 44  # more than the pieces of any one length

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)


def shortest_pack_first(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns and how often each is used. Work depends on the number of lengths, not of pieces."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    free: list[int] = []  # negative room left, a heap

    def put(left: int, pattern: tuple[int, ...], count: int) -> None:
        if left not in room:
            room[left] = []
            heapq.heappush(free, -left)
        room[left].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        waiting = histogram[length]
        while waiting:
            if not free or -free[0] < length:
                # New packs: each is the shortest until it is full, so it takes as many as it holds.
                each = limit // length
                if waiting >= each:
                    put(limit - each * length, (length,) * each, waiting // each)
                if waiting % each:
                    put(limit - waiting % each * length, (length,) * (waiting % each), 1)
                break
            left = -free[0]
            pattern, count = room[left].pop()
            if not room[left]:
                del room[left]
                heapq.heappop(free)
            used = min(count, waiting)
            waiting -= used
            if count > used:
                put(left, pattern, count - used)
            put(left - length, (*pattern, length), used)
    return [(p, c) for left in sorted(room) for p, c in room[left]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted; each covers the ranks up to the next."""
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, offset))
            next_rank[length] = rank + count
            offset += length
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def cut_pieces(
    df: DataFrame, path: str, end_id: int, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece; a null text is empty, its end id remains."""
    end = struct.pack("<I", end_id)

    def run(batches):
        encode = encoder(path).ids
        for batch in batches:
            columns = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                tokens = len(ids) // 4
                for start in range(0, tokens, limit):
                    piece = ids[4 * start : 4 * (start + limit)]
                    for column, value in zip(columns, (doc, start, len(piece) // 4, zlib.crc32(piece), tokens)):
                        column.append(value)
            yield batch_of(_PIECES, list(columns))

    return small_batches(id_and_text(df, id_col, text_col)).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def pack(
    df: DataFrame, path: str, end_id: int, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces with sequence_id and offset: gapless in each sequence, every id in exactly one piece.

    An empty input gives no rows; repeated ids are packed as documents of their own.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A length can be that of a third of all pieces, so ranks are counted by length and bucket.
    pieces = staged(
        cut_pieces(df, path, end_id, limit, id_col, text_col).withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "ids_crc32"), F.lit(partitions))
        ),
        "pieces",
    )
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(shortest_pack_first(histogram, limit))
    keys = table[:, 0] * _RANKS + table[:, 1]

    within = W.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("n", F.row_number().over(within) - 1)
        .join(base, ["length", "bucket"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("n")).alias("rank"))
    )

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, length * _RANKS + rank, "right") - 1]
            found = [pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=names)

    return ranked.mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
