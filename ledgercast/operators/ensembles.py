"""Tree ensembles as tables: one row per node, scored by joins or over vectors.

An ensemble's size is set by its settings (trees and depth), never by the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgercast.session import stage_path
from ledgercast.sources.local_table import broadcast_if_small

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, weight double"
LEAF = -1
# Nodes of one ensemble that may be held by a task: 120 trees of depth 12.
MOST_NODES = 1_000_000


def ensemble_nodes(spark: SparkSession, path: str, votes: bool = False) -> DataFrame:
    """``tree, node, feature, threshold, left, right, value, weight`` of a saved MLlib ensemble.

    Rows with ``feature`` -1 are leaves. A row goes left if its feature is at most the threshold. With
    ``votes`` a leaf's value is the share of the second class, as a forest of classifiers counts it.
    """
    n = F.col("nodeData")
    stats = n["impurityStats"]
    share = F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda total, x: total + x)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), (share if votes else n["prediction"]).alias("value"),
    )
    return nodes.join(weights, "tree")


def saved_nodes(model, votes: bool = False) -> DataFrame:
    """The nodes of a fitted ensemble, by way of a folder that all executors share."""
    spark = SparkSession.active()
    path = stage_path(spark, "ensemble")
    model.write().save(path)
    return ensemble_nodes(spark, path, votes)


def tree_sums(rows: DataFrame, features: str, nodes: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, total, trees``: weighted sum of the leaf values of every row, and the number of trees.

    ``features`` is an array column. Every row walks all trees at once, one join with the nodes per
    level; the trees of a row stay in its task, so they are summed before the exchange. ``keep`` names a
    row: rows with equal keys are summed together. Rows without features, or with a null among those asked, go right.
    """
    count, depth = nodes.count(), max_depth(nodes)
    trees = [r["tree"] for r in nodes.select("tree").distinct().orderBy("tree").collect()]
    table = broadcast_if_small(nodes, count)
    roots = nodes.join(nodes.select("tree", F.explode(F.array("left", "right")).alias("node")), ["tree", "node"], "left_anti")
    start = {r["tree"]: r["node"] for r in roots.select("tree", "node").collect()}
    cursors = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(start[t]).alias("node")) for t in trees])
    walking = rows.select(*keep, F.col(features).alias("x"), F.explode(cursors).alias("c")).select(*keep, "x", "c.*")
    for _ in range(depth):
        met = walking.join(table, ["tree", "node"])
        goes_left = F.coalesce(F.get("x", F.col("feature")) <= F.col("threshold"), F.lit(False))
        onward = F.when(F.col("feature") == LEAF, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        walking = met.select(*keep, "x", "tree", onward.alias("node"))
    leaves = walking.join(table, ["tree", "node"])
    total = F.sum(F.col("value") * F.col("weight")).alias("total")
    return leaves.groupBy(*keep).agg(total, F.count("*").alias("trees"))


def max_depth(nodes: DataFrame) -> int:
    """Levels below the roots, from child links alone."""
    children = {(r["tree"], r["node"]): (r["left"], r["right"]) for r in bounded_nodes(nodes) if r["feature"] != LEAF}
    below = {k for k in children}
    inner = {(t, c) for (t, _), pair in children.items() for c in pair}
    level, depth = [k for k in below if k not in inner], 0
    while level:
        depth += 1
        level = [(t, c) for t, n in level for c in children[t, n] if (t, c) in children]
    return depth


def bounded_nodes(nodes: DataFrame) -> list:
    found = nodes.limit(MOST_NODES + 1).collect()
    if len(found) > MOST_NODES:
        raise ValueError(f"an ensemble of more than {MOST_NODES} nodes does not fit a task")
    return found


def boosted_score(total: Column, classifier: bool = False) -> Column:
    """Score of a boosted ensemble from its weighted sum: the sum, or the chance that its margin stands for."""
    return 1 / (1 + F.exp(-2 * total)) if classifier else total


def forest_score(total: Column, trees: Column) -> Column:
    """Score of a forest: the mean over its trees."""
    return total / trees


class TreeTable:
    """Nodes as arrays by tree, for walks over a whole batch of vectors."""

    def __init__(self, rows: list):
        trees = sorted({r["tree"] for r in rows})
        place = {t: k for k, t in enumerate(trees)}
        index: dict[tuple[int, int], int] = {}
        for r in sorted(rows, key=lambda r: (r["tree"], r["node"])):
            index[r["tree"], r["node"]] = len(index)
        self.feature, self.threshold, self.value = np.zeros(len(index), dtype=np.int64), np.zeros(len(index)), np.zeros(len(index))
        self.left, self.right = np.arange(len(index)), np.arange(len(index))
        self.weight = np.zeros(len(trees))
        child = np.zeros(len(index), dtype=bool)
        for r in rows:
            at = index[r["tree"], r["node"]]
            self.value[at], self.weight[place[r["tree"]]] = r["value"], r["weight"]
            if r["feature"] != LEAF:
                self.feature[at], self.threshold[at] = r["feature"], r["threshold"]
                self.left[at], self.right[at] = index[r["tree"], r["left"]], index[r["tree"], r["right"]]
                child[[self.left[at], self.right[at]]] = True
        self.roots = np.flatnonzero(~child)

    def values(self, x: np.ndarray) -> np.ndarray:
        """Weighted leaf value of every row (first axis) in every tree, in the order of the trees."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        while True:
            onward = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            if (onward == at).all():
                return self.value[at] * self.weight
            at = onward


WALKED = 4096


def prefix_scores(rows: DataFrame, vector: str, nodes: DataFrame, rounds: list[int], keep: list[str]) -> DataFrame:
    """``keep`` and ``after``: the sums over the first trees of a boosted ensemble, an array with one for each of ``rounds``."""
    table = TreeTable(bounded_nodes(nodes))
    last = np.minimum(np.array(rounds), len(table.roots)) - 1

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def after(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for start in range(0, len(batch), WALKED):
                x = np.stack(batch.iloc[start : start + WALKED].to_numpy())
                out.extend(np.cumsum(table.values(x), axis=1)[:, last])
            yield pd.Series(out, dtype=object)

    return rows.select(*keep, after(vector_to_array(vector)).alias("after"))
