"""Shards by jump consistent hashing: the key and the number of shards decide, no table of rings.

Going from n to n + 1 shards moves 1 in n + 1 rows, all of them into the new shard. Integer keys are
used as they are (null as 0), other keys by their hash. Rows with equal keys share a shard.
Inside a shard every row has a slot, numbered from 0 without gaps: rows are counted per
(shard, bucket of a hash), so no task ever holds a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgercast.llm.words import byte_count
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

BUCKETS = 1024
MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; all keys jump at once until none lands inside."""
    keys = keys.astype(np.uint64)
    shard = np.zeros(len(keys), dtype=np.int64)
    live = np.arange(len(keys))
    while len(live):
        keys = keys * MULTIPLIER + np.uint64(1)
        divisor = ((keys >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump = np.floor((shard[live] + 1) * (float(1 << 31) / divisor))
        inside = jump < shards
        live, keys = live[inside], keys[inside]
        shard[live] = jump[inside].astype(np.int64)
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    if shards < 1:
        raise ValueError("there must be a shard")

    @F.pandas_udf(T.IntegerType())
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return shard(F.coalesce(key, F.lit(0)).cast("long"))


def key_column(docs: DataFrame, key: str) -> Column:
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    column = F.col(f"`{key}`")
    return column if isinstance(docs.schema[key].dataType, whole) else F.xxhash64(column)


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", digest: bool = False) -> DataFrame:
    """``row`` (the given row), ``size``, ``text_crc32``, ``shard``, ``grown_shard``, ``slot``.

    With ``digest`` the row is reduced to its key. Null texts have no bytes; equal rows get
    different slots in any order.
    """
    spark = docs.sparkSession
    names = [key] if digest else docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        key_column(docs, key).alias("key"),
        (byte_count(F.col("text")) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = measured.withColumns(
        {
            "shard": jump_shard(F.col("key"), shards),
            "grown_shard": jump_shard(F.col("key"), shards + 1),
            "bucket": F.pmod(F.xxhash64("key", "text_crc32", "size"), F.lit(BUCKETS)).cast("int"),
        }
    )
    placed = staged(placed, stage_path(spark, "placed"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "text_crc32", "size")
    return placed.join(offsets, ["shard", "bucket"]).select(
        "row", "size", "text_crc32", "shard", "grown_shard",
        (F.row_number().over(inside) - 1 + F.col("offset")).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """The given rows with ``shard`` and ``slot``; columns of these names are replaced."""
    out = shard_rows(docs, shards, key)
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]
    return out.select(*kept, "shard", "slot")


def write_shards(docs: DataFrame, shards: int, path: str, key: str = "doc_id") -> str:
    """One folder per shard, rows of each file in slot order."""
    out = shard_documents(docs, shards, key)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def shard_digest(docs: DataFrame, shards: int) -> DataFrame:
    """Placement of every row: sizes, checksum, law, shard, slot, and the shard with one more."""
    out = shard_rows(docs, shards, digest=True)
    return out.select(
        "row.doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
