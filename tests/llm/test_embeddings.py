"""Embedding groups against all pairs, and the graphs by themselves."""

import numpy as np
import pytest

from ledgercast.llm import embedding_dedup, queries, small_world

SCHEMA = "vec_id long, embedding array<float>, label int, node long, key string, shard long, copies long"


def brute(rows, similar=0.95):
    """{row number: (n_links, component_id)} of (vec_id, embedding) rows."""
    units = []
    for _, v in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(np.float64) if ok else None
        units.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    count, root = len(rows), list(range(len(rows)))
    links = [0] * count
    for a in range(count):
        for b in range(a + 1, count):
            if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= similar:
                links[a] += 1
                links[b] += 1
                root = [root[a] if r == root[b] else r for r in root]
    first = {}
    for k, (i, _) in enumerate(rows):
        known = first.get(root[k])
        first[root[k]] = known if i is None else i if known is None else min(i, known)
    return sorted([(i, links[k], first[root[k]]) for k, (i, _) in enumerate(rows)], key=str)


def result(spark, rows):
    table = spark.createDataFrame([(i, v, 0, 1, "clash", 2, 3) for i, v in rows], SCHEMA)
    out = embedding_dedup.embedding_groups(table).collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in out)
    return sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in out], key=str)


@pytest.mark.parametrize("shard_rows", [100, 100_000])
def test_groups_match_all_pairs(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(shard_rows)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(250, 12)))]
    for k in range(90):  # chains and dense groups around a few of them
        base = np.array(rows[k % 7][1] if k % 2 else rows[-1][1])
        rows.append((1000 - k, (base + 0.25 * rng.normal(size=12)).tolist()))
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [nan] + [1.0] * 11), (2004, [inf] * 12), (2005, [None] + [1.0] * 11)]
    rows += [(2010, [1.0, 2.0]), (2011, [2.0, 4.0]), (2012, [1e-38, 2e-38]), (None, [1.0, 2.0]), (None, None), (2010, [1.0, 2.0])]
    rows += [(3000 + k, rows[3][1]) for k in range(60)] + [(2006, [-0.0] * 12), (3, rows[3][1])]
    assert result(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert result(spark, []) == []
    assert result(spark, [(5, [1.0, 0.0])]) == [(5, 0, 5)] and result(spark, [(5, None)]) == [(5, 0, 5)]
    assert result(spark, [(None, [1.0]), (None, [3.0])]) == [(None, 1, None)] * 2


def test_graph_finds_the_nearest():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 32))
    vectors = np.concatenate([centres[rng.integers(0, 30, 1500)] + 0.6 * rng.normal(size=(1500, 32)), np.repeat(centres[:1], 40, axis=0)])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = small_world.build(vectors)
    assert len(graph.links) > 1 and (graph.links[0][:, 0] >= 0).all()
    ids, _ = small_world.nearest(graph, vectors[:300], 64)
    true = np.argsort(-(vectors[:300] @ vectors.T), axis=1)[:, :10]
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, true)])
    assert recall >= 0.95, recall


@pytest.mark.parametrize("count", [1, 2, 3, 17])
def test_small_graphs_are_whole(count):
    vectors = np.eye(count)
    ids, near = small_world.nearest(small_world.build(vectors), vectors, count)
    assert all(sorted(row) == list(range(count)) for row in ids) and (near.max(axis=1) == 1).all()


def test_recall_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op13_embedding_groups(spark, sf).collect()
    assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in got], key=str) == brute(rows)
