"""Exact duplicates by content sort, in DataFrame functions only.

Sampled splitters cut the rows into ranges of (leading bytes, digest, salt) of the normalised text,
every range is sorted externally, which places equal texts next to each other, and each row is
compared in full with its neighbour. A splitter holds the leading bytes and the digest, not a whole
text: the splitters are gathered on the driver, and texts have no bound.

A text that is so frequent that it would fill a range alone is spread over several by a salt. There
are fewer than `4 x partitions` such texts, whatever the data, so their group facts, merged map-side,
are broadcast.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Leading characters of the normalised text in the sort key; ties are ordered by the digest.
HEAD_CHARS = 32
# A text is spread once it has more than 1 / (HOT_SHARES x partitions) of all rows.
HOT_SHARES = 4


def normalised(text: Column) -> Column:
    """Lower-case A-Z and nothing else; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).otherwise(folded)


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `row` (all its columns), id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. The row with the largest id stays; a null
    id counts as the smallest, and of rows that share the largest id one stays. An empty input gives
    no rows; other columns, whatever their names, are carried inside `row`.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.col("row")[text_col]
    keyed = (
        df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        .withColumn("id", F.col("row")[id_col])
        .withColumn("norm", normalised(text))
        .withColumn("head", F.substring("norm", 1, HEAD_CHARS))
        .withColumn("digest", F.sha2("norm", 256))
        .drop("norm")
    )
    rows = df.count()
    hot = (
        keyed.groupBy("digest")
        .agg(F.count("*").alias("hot_size"), F.max("id").alias("hot_keep"))
        .where(F.col("hot_size") * HOT_SHARES * partitions > max(rows, HOT_SHARES * partitions))
        .withColumn("shares", F.ceil(F.col("hot_size") * HOT_SHARES * partitions / F.lit(max(rows, 1))))
    )
    spread = keyed.join(F.broadcast(hot), "digest", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("id"), "shares"), F.lit(0).cast("long"))
    )
    ranges = spread.repartitionByRange("head", "digest", "salt")

    same = W.partitionBy("head", "digest", "salt")
    ordered = same.orderBy(F.col("id").desc_nulls_last())
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.lag(text).over(ordered)
    marked = ranges.select(
        "row",
        "id",
        "digest",
        "hot_size",
        "hot_keep",
        # The neighbour's whole text is compared; equal digests of different texts would stop the job.
        F.when(F.row_number().over(ordered) == 1, F.lit(True))
        .when(normalised(before) == normalised(text), F.lit(False))
        .otherwise(F.raise_error(F.lit("two different texts share one digest")).cast("boolean"))
        .alias("first"),
        F.max("id").over(whole).alias("range_keep"),
        F.count("*").over(whole).alias("range_size"),
    )
    is_hot = F.col("hot_size").isNotNull()
    return marked.select(
        "row",
        "id",
        F.when(is_hot, F.col("hot_keep")).otherwise(F.col("range_keep")).alias("keep_id"),
        F.coalesce("hot_size", "range_size").alias("group_size"),
        (F.col("first") & (~is_hot | F.col("id").eqNullSafe(F.col("hot_keep")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input."""
    return mark_copies(df, id_col, text_col).where("kept").select("row.*")
