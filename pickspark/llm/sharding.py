"""Sharding by jump consistent hashing: a stable key and the shard count alone decide the shard, and
one more shard takes rows only into itself (one row in ``n + 1``, on average). No ring table is kept.

Slots number the rows of each shard without gaps. They come from one range partitioning by
(shard, key): each task numbers its own rows and only counts per task and shard are summed, so no shard
is ever gathered in one task.

Edge cases: a null key goes to shard 0 with its own slots; a null text has size 16 (the fixed overhead)
and the crc32 of no bytes, 0; rows with equal keys share a shard and get slots in the order of text
crc32 and size; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

#: Bytes counted for each row besides its text.
OVERHEAD = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys (Lamping and Veach 2014)."""
    key = keys.astype(np.uint64)
    held, nxt = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            held[live] = nxt[live]
            key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
            draw = ((key[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            nxt[live] = ((held[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            live = live[nxt[live] < shards]
    return held


def shard_of(key: Column, shards: int) -> Column:
    """The shard of ``key``: it is hashed first, so dense ids spread as well as random ones."""

    @F.pandas_udf("int")
    def pick(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64).copy(), shards), dtype="int32")

    return F.when(key.isNull(), F.lit(0)).otherwise(pick(F.xxhash64(key)))


def assign(df: DataFrame, shards: int, key_col: str = "doc_id", order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one shard more) and ``slot`` (0, 1, ... in each shard)."""
    keyed = written(
        df.withColumns({"shard": shard_of(F.col(key_col), shards), "grown_shard": shard_of(F.col(key_col), shards + 1)})
        .repartitionByRange("shard", key_col)
        .sortWithinPartitions("shard", key_col, *order_cols)
        .withColumn("_at", F.monotonically_increasing_id()),
        "shards",
    )
    # _at holds the task's number in its upper bits and the row's place in the task in the lower 33.
    task = F.shiftright("_at", 33)
    runs = keyed.groupBy("shard", task.alias("_task")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(_window()) - F.col("_rows")
    starts = runs.select("shard", "_task", "_first", before.alias("_before"))
    # One row for each task and shard it holds: tasks + shards rows at most, whatever the table's size.
    return (
        keyed.withColumn("_task", task)
        .join(F.broadcast(starts), ["shard", "_task"])
        .withColumn("slot", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_task", "_first", "_before")
    )


def _window():
    from pyspark.sql import Window

    return Window.partitionBy("shard").orderBy("_task")


def documents_to_shards(documents: DataFrame, shards: int = 40) -> DataFrame:
    rows = documents.select(
        "doc_id",
        (F.octet_length(text_or_empty()) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    out = assign(rows, shards, "doc_id", ("text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
