"""Connected components of a graph given as edges, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgercast.session import stage_path
from ledgercast.sources.stages import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), F.col("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and all its smaller neighbours to the smallest of them. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    joined = edges.join(least, "b")
    moved = joined.where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("least").alias("a"), F.col("b")))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node but the roots themselves.

    ``edges`` has two columns of one ordered type. Alternating stars halve the distances each round;
    every round is written out, so a lost executor costs one round. A table of edges without
    rows gives none.
    """
    spark = edges.sparkSession
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    plain = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    current = staged(plain, stage_path(spark, "edges"))
    mark = _fingerprint(current)
    for _ in range(rounds):
        if not mark[0]:
            break
        starred = _large_star(current).where("a < b").distinct()
        current = staged(_small_star(starred).distinct(), stage_path(spark, "edges"))
        before, mark = mark, _fingerprint(current)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
