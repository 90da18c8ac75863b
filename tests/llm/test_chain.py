"""The whole pipeline on small tables: null ids, null and repeated rows, clashing columns, nothing at all."""

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, source string, row string, own string, text_key string, hash long, position int, node long, cell long"


def words(rng, count):
    return " ".join("".join(rng.choice("abcdeiou") for _ in range(rng.randint(3, 8))) for _ in range(count))


def written(spark, folder, docs, items):
    rows = [(i, t, s, "r", "o", "k", 1, 2, 3, 4) for i, t, s in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_rows_of_all_kinds(spark, tmp_path):
    rng = random.Random(1)
    clean = [(i, words(rng, 60), "a" if i % 3 else None) for i in range(30)]
    item = words(rng, 20)
    near = clean[0][1].split()
    near[30] = "changed"
    docs = clean + [
        (None, None, "a"), (50, "", "b"), (51, " \n", "b"), (52, "too short", "b"), (None, words(rng, 50), "b"),
        (60, " ".join(near), "a"), clean[1], (61, clean[2][1].upper(), "b"), (62, f"{words(rng, 40)} {item} {words(rng, 9)}", "b"),
        (63, words(rng, 6000), "a"),
    ]
    folder = written(spark, tmp_path, docs, [(1, item), (2, None), (3, "")])
    out = corpus_pipeline.run(spark, folder).collect()
    ids = [r["doc_id"] for r in out]
    assert set(out[0].asDict()) == {*[f.split()[0] for f in SCHEMA.split(", ")], "shard", "slot"}
    assert not {50, 51, 52, 60, 61, 62} & set(ids) and all(r["text"] for r in out)
    assert set(ids) <= {*range(30), None, 63} and max(map(ids.count, ids)) <= 3
    for shard in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))


def test_nothing_at_all(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [])).collect() == []
