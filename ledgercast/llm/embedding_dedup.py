"""Near duplicates among embeddings: cosine links found in small-world graphs, one graph per shard.

Distinct vectors are dealt by hash into shards of a bounded size, each indexed whole by a task of its own.
Every vector asks every shard: a pair of shards meets once, vectors of one walk the graph of the other. A
pair's beam starts narrow; it widens until an audit by brute force finds the links it should, and a query
whose beam is full of links gets a wider one. Past a quarter of the shard the brute force answers itself.
Links are verified in double precision. A task returns how many vectors each vector is linked with and edges
that span its linked groups, never all pairs; components of the edges are found by joins.

Equal vectors are one node with its number of rows, so a hot vector costs no more than another. Vectors that
are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
different lengths. Null ids never name a component; repeated ids are told apart by their vectors. The work is
a beam search for each vector and shard, so shards should be as large as a task's memory allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.llm.components import components
from ledgercast.llm.small_world import BLOCK, Graph, build, nearest
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

SIMILAR = 0.95
SHARD_ROWS = 16_384
FIRST_BEAM = 32
WIDEST = 128  # a beam past this costs more than asking all nodes of a shard
AUDIT = 256  # vectors asked by brute force for each pair of shards, and as many that have links
AUDIT_RECALL = 0.99
BROADCAST_DIMENSIONS = 4096
SLACK = 1e-4  # single precision while walking; the double product decides
NODE = "shard long, node long, copies long, embedding array<double>"


def links_with_others(embedding: Column) -> Column:
    """Whether a vector has a direction: finite components, not all of them zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def vector_key(embedding: Column) -> Column:
    """Identity of a vector: 128 bits of its shortest decimal form."""
    return F.md5(F.concat_ws(",", embedding.cast("array<string>")))


def _doubles(table: pa.Table, column: str = "embedding") -> np.ndarray:
    """Unit vectors of a column of arrays of one length, in double precision."""
    values = table.column(column).combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
    scaled = flat / np.abs(flat).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _long(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


GRAPH = NODE + ", entry long, links array<array<long>>"


def build_shard(table: pa.Table) -> pa.Table:
    """The rows of a shard in the order of their nodes, with their links on every level they are on."""
    table = table.sort_by("node")
    graph = build(_doubles(table))
    rows = [[links[i].tolist() for links in graph.links] for i in range(table.num_rows)]
    return table.append_column("entry", pa.array([graph.entry] * len(rows), pa.int64())).append_column(
        "links", pa.array(rows, pa.list_(pa.list_(pa.int64())))
    )


def read_shard(table: pa.Table) -> tuple[pa.Table, np.ndarray, Graph]:
    table = table.sort_by("node")
    vectors = _doubles(table)
    levels = [np.array(level, dtype=np.int64) for level in zip(*table.column("links").to_pylist())]
    return table, vectors, Graph(np.ascontiguousarray(vectors, dtype=np.float32), levels, int(table.column("entry")[0].as_py()))


def linked(graph: Graph, vectors: np.ndarray, queries: np.ndarray, width: int, similar: float) -> np.ndarray:
    """For each query, which nodes of the graph it is linked with: those met by a beam of ``width``, by a
    wider one where half of the beam is links. Past ``WIDEST`` or a quarter of the graph all nodes are asked."""
    if width > WIDEST or 4 * width >= len(vectors):
        return queries @ vectors.T >= similar
    out = np.zeros((len(queries), len(vectors)), dtype=bool)
    ids, near = nearest(graph, queries, width)
    at, place = np.nonzero((near >= similar - SLACK) & (ids >= 0))
    met = ids[at, place]
    sure = np.einsum("ij,ij->i", queries[at], vectors[met]) >= similar
    out[at[sure], met[sure]] = True
    full = np.flatnonzero(2 * np.bincount(at, minlength=len(queries)) >= width)
    if len(full):
        out[full] = linked(graph, vectors, queries[full], 4 * width, similar)
    return out


def audited_width(graph: Graph, vectors: np.ndarray, queries: np.ndarray, similar: float) -> int:
    """A beam wide enough to find ``AUDIT_RECALL`` of the links of audited queries.

    They are spread over the shard, whose order is that of a hash; those with links are what a narrow
    beam finds, so the first audit is followed by one over vectors that do have links.
    """
    width = FIRST_BEAM
    spread = np.unique(np.linspace(0, len(queries) - 1, min(len(queries), 8 * AUDIT)).astype(np.int64))
    true = queries[spread] @ vectors.T >= similar
    of_interest = np.flatnonzero(true.sum(axis=1) > 0)[:AUDIT]
    chosen = np.unique(np.r_[np.arange(min(AUDIT, len(spread))), of_interest])
    asked, true = queries[spread[chosen]], true[chosen]
    while width <= WIDEST and 4 * width < len(vectors):
        found = linked(graph, vectors, asked, width, similar)
        if (found & true).sum() >= AUDIT_RECALL * true.sum():
            return width
        width *= 2
    return width


FOUND = "kind string, node long, other long, links long"


def _spanning(hits: np.ndarray, first: int, group_of_query: np.ndarray, group_of_node: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (query, node) that join groups not joined before, for a block of queries."""
    edges = []
    for row in np.flatnonzero(hits.any(axis=1)):
        nodes = np.flatnonzero(hits[row])
        groups, at = np.unique(group_of_node[nodes], return_index=True)
        own = group_of_query[first + row]
        new = groups != own
        for group, node in zip(groups[new].tolist(), nodes[at[new]].tolist()):
            edges.append((first + row, node))
            group_of_node[group_of_node == group] = own
            group_of_query[group_of_query == group] = own
    return edges


def links_between(similar: float):
    """Of two shards, or of one with itself: rows of link counts, and edges that span the linked groups."""

    def pair(asking: pa.Table, indexed: pa.Table) -> pa.Table:
        if not asking.num_rows or not indexed.num_rows:
            return pa.table({"kind": [], "node": [], "other": [], "links": []}, FOUND_SCHEMA)
        same = asking.column("shard")[0].as_py() == indexed.column("shard")[0].as_py()
        indexed, vectors, graph = read_shard(indexed)
        asking = asking.sort_by("node")
        queries = vectors if same else _doubles(asking)
        names, others = _long(asking, "node"), _long(indexed, "node")
        copies, other_copies = _long(asking, "copies"), _long(indexed, "copies")
        width = audited_width(graph, vectors, queries, similar)
        count, other_count = np.zeros(len(names), dtype=np.int64), np.zeros(len(others), dtype=np.int64)
        groups = np.arange(len(names))
        other_groups = groups if same else np.arange(len(others)) + len(names)
        both = np.zeros((len(others), (len(others) + 7) // 8), dtype=np.uint8) if same else None
        edges: list[tuple[int, int]] = []
        for first in range(0, len(queries), BLOCK):
            hits = linked(graph, vectors, queries[first : first + BLOCK], width, similar)
            if same:
                hits[np.arange(len(hits)), first + np.arange(len(hits))] = False
                both[first : first + len(hits)] |= np.packbits(hits, axis=1)
            else:
                count[first : first + len(hits)] += hits @ other_copies
                other_count += copies[first : first + len(hits)] @ hits
            edges += _spanning(hits, first, groups, other_groups)
        if same:  # a link that one side found is a link of both
            for first in range(0, len(names), 8 * BLOCK):
                rows = np.unpackbits(both[first : first + 8 * BLOCK], axis=1, count=len(names)).astype(bool)
                back = np.unpackbits(both[:, first // 8 : first // 8 + BLOCK], axis=1)[:, : len(rows)].T.astype(bool)
                count[first : first + len(rows)] += (rows | back) @ copies
        counted, other_counted = np.flatnonzero(count), np.flatnonzero(other_count)
        left, right = np.array(edges, dtype=np.int64).reshape(-1, 2).T
        kinds = ["count"] * (len(counted) + len(other_counted)) + ["edge"] * len(edges)
        node = np.concatenate([names[counted], others[other_counted], names[left]])
        other = np.concatenate([np.full(len(counted) + len(other_counted), -1), others[right]])
        links = np.concatenate([count[counted], other_count[other_counted], np.zeros(len(edges), dtype=np.int64)])
        return pa.table({"kind": kinds, "node": node, "other": other, "links": links}, FOUND_SCHEMA)

    return pair


FOUND_SCHEMA = pa.schema([("kind", pa.string()), ("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def vector_nodes(vectors: DataFrame) -> DataFrame:
    """``key, node, shard, dimension, copies, embedding`` of the distinct vectors that can link.

    Nodes are numbered once and written. Shards of one length hold about ``SHARD_ROWS`` nodes.
    """
    spark = vectors.sparkSession
    able = vectors.where(links_with_others(F.col("embedding"))).select(F.col("embedding").cast("array<double>").alias("embedding"), vector_key(F.col("embedding")).alias("key"))
    distinct = able.groupBy("key").agg(F.first("embedding").alias("embedding"), F.count("*").alias("copies"))
    nodes = distinct.select(F.monotonically_increasing_id().alias("node"), "*", F.size("embedding").alias("dimension"))
    nodes = staged(nodes, stage_path(spark, "nodes"))
    sizes = staged(
        nodes.groupBy("dimension").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("shards"), F.min("node").alias("first")),
        stage_path(spark, "dimensions"),
    )
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_DIMENSIONS else sizes
    return nodes.join(sizes, "dimension").withColumn("shard", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards")))


def cosine_links(nodes: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``kind, node, other, links``: counts of linked rows per node and pair of shards, and spanning edges."""
    spark = nodes.sparkSession
    columns = ["shard", "node", "copies", "embedding"]
    indexed = nodes.groupBy("dimension", "shard").applyInArrow(
        lambda table: build_shard(table.select([*columns, "dimension", "shards"])), GRAPH + ", dimension int, shards long"
    )
    graphs = staged(indexed.select("dimension", "shards", *columns, "entry", "links"), stage_path(spark, "graphs"))
    # Row of shard s goes to the pairs (s, s) … (s, last); the graph of shard t to (0, t) … (t, t).
    asking = nodes.select("dimension", *columns, F.col("shard").alias("s"), F.explode(F.sequence("shard", F.col("shards") - 1)).alias("t"))
    asked = graphs.select("dimension", *columns, "entry", "links", F.explode(F.sequence(F.lit(0).cast("long"), "shard")).alias("s"), F.col("shard").alias("t"))
    key = ["dimension", "s", "t"]
    return asking.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(links_between(similar), FOUND)


def embedding_groups(vectors: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``)."""
    spark = vectors.sparkSession
    nodes = vector_nodes(vectors)
    found = staged(cosine_links(nodes, similar), stage_path(spark, "found"))
    counts = found.where("kind = 'count'").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("kind = 'edge'").select(F.col("node").alias("a"), F.col("other").alias("b")))
    of_node = nodes.select("key", "node", "copies").join(counts, "node", "left").join(roots, "node", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
    )
    rows = vectors.select("vec_id", F.when(links_with_others(F.col("embedding")), vector_key(F.col("embedding"))).alias("key"))
    firsts = rows.groupBy("key").agg(F.min("vec_id").alias("first_id")).join(of_node, "key")
    named = firsts.join(firsts.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("key", "n_links", "component_id")
    named = staged(named, stage_path(spark, "named"))
    labelled = rows.join(named, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return labelled.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
