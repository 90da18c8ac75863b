"""Hash buckets of clients: a client always falls into the same bucket, on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def positive_hash(key: Column, kind: str = "murmur3") -> Column:
    """Non-negative 64-bit hash of a string key.

    ``murmur3`` is Spark's own hash; it is widened before ``abs`` because the smallest 32-bit
    value has no positive counterpart. ``md5`` gives the same value in any SQL engine.
    """
    text = key.cast("string")
    if kind == "murmur3":
        return F.abs(F.hash(text).cast("long"))
    if kind == "md5":
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    raise ValueError(f"unknown hash kind {kind!r}")


def client_bucket(client: Column, buckets: int, kind: str = "murmur3") -> Column:
    return positive_hash(client, kind) % F.lit(buckets).cast("long")
