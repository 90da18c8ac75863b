"""Quality, mixing, sharding, near duplicates, templates, URL lists and the pipeline against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from check import connect, difference
from ledgercast.llm import decontaminate, mixing, quality, queries, sharding, simhash, url_filter
from ledgercast.llm.components import components

SCHEMA = "doc_id long, text string, source string, row string, bucket int, size int, key int, k int"


def table(spark, rows):
    """Documents with extra columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, s, "r", 1, 2, 3, 4) for i, t, s in rows], SCHEMA)


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(i, prose(rng, rng.randint(25, 90)), rng.choice(["a", "b", "B", "é", None])) for i in range(60)]
    out += [(100, out[3][1], "a"), (100, out[3][1], "a"), (None, out[4][1], "b"), (None, None, None), (101, "", "z"), (102, " \n", "z")]
    long = prose(rng, 200).split()
    for k in range(8):
        words = list(long)
        words[7 * k + 3] = "changed"
        out.append((200 + k, " ".join(words), "c"))
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE[name]) is None


def test_empty_tables(spark, sf):
    empty = table(spark, [])
    benchmark = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string")
    for df in (
        quality.quality_ledger(empty), mixing.mix_digest(empty), mixing.mix_documents(empty), sharding.shard_digest(empty, 8),
        simhash.near_duplicates(empty), simhash.keep_one_of_each(empty), decontaminate.contaminated_items(empty, benchmark),
        decontaminate.drop_contaminated(empty, benchmark), url_filter.judge_captures(queries.captures(pages), queries.list_entries(pages)),
    ):
        assert df.count() == 0


def test_repeated_words_equal_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))] + [str(i).encode() for i in range(rng.randint(0, 9))]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
        assert quality.repeated_words(words) == len(covered)


def test_ablations_count_what_one_rule_rejects_alone(spark):
    ledger = spark.createDataFrame([(1, 0), (2, 1), (3, 5), (4, 4)], "doc_id long, failures long")
    got = {r["rule"]: (r["failed"], r["alone"]) for r in quality.ablations(ledger).collect()}
    assert got["few_words"] == (2, 1) and got["symbols"] == (2, 1) and got["shouting"] == (0, 0)


def test_jump_hash_moves_rows_only_into_the_new_shard(spark, rows):
    def jump(key, shards):
        at, b, j = key % (1 << 64), -1, 0
        while j < shards:
            b = j
            at = (at * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / ((at >> 33) + 1)))
        return b

    keys = np.array([0, 1, 5, 10**12, -3, *range(1000)], dtype=np.int64)
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys.view(np.uint64), shards).tolist() == [jump(int(k), shards) for k in keys]
    got = sharding.shard_digest(table(spark, rows), 8).collect()
    raw = lambda t: (t or "").encode()
    assert Counter((r[0], r[1], r[2]) for r in got) == Counter((i, len(raw(t)) + 1, zlib.crc32(raw(t))) for i, t, _ in rows)
    for r in got:
        assert r["shard"] == jump(r["doc_id"] or 0, 8) and r["grown_shard"] in (r["shard"], 8)
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_mix_takes_what_one_queue_would(spark, rows, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL_RANGE", 2)
    monkeypatch.setattr(mixing, "RANGES", 3)
    docs = table(spark, rows)
    got = mixing.mix_digest(docs).collect()
    budget = sum(r["size"] for r in got)
    assert budget == sum(len((t or "").encode().split()) for _, t, _ in rows) and len(got) == len(rows)
    assert 0 <= budget - sum(r["taken"] for r in got) <= max(r["size"] for r in got)
    assert abs(sum({r["source_size"]: r["target"] for r in got}.values()) - budget) < 1e-6
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r["text"] or "").encode().split()) for r in mixed.collect()) == sum(r["taken"] for r in got)


def test_fingerprints_and_groups_equal_brute_force(spark, rows):
    import xxhash

    def reference(text):
        w = (text or "").encode().lower().split()
        grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    prints = [reference(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    want = Counter(
        (rows[i][0], f"{prints[i]:016x}", min((d for d in ids[find(i)] if d is not None), default=None)) for i in range(len(rows))
    )
    assert Counter(tuple(r) for r in simhash.near_duplicates(table(spark, rows)).collect()) == want


def test_anchors_meet_all_pairs_within_two_bits():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.array([np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, rng.integers(0, 3), replace=False).astype(np.uint64)) for _ in points], dtype=np.uint64)
    a, i = simhash.replicas(points)
    b, j = simhash.replicas(points ^ flips)
    assert set(range(300)) == {x for x in range(300) if set(a[i == x]) & set(b[j == x])}


def test_large_cells_and_many_batches_link_alike():
    rng = np.random.default_rng(5)
    base = np.uint64(12345678901234567)
    points = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)))
    group = simhash.cell_stars(points, 2)
    assert (group == group[0]).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + k) for k in range(1, 30)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "x long, y long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{1000 + k: 1000 for k in range(1, 30)}}


def test_one_of_each_near_duplicate_stays(spark, rows):
    kept = simhash.keep_one_of_each(table(spark, rows)).collect()
    ids = Counter(r["doc_id"] for r in kept)
    assert all(ids[i] == 1 for i in range(60)) and ids[100] == 0 and sum(ids[200 + k] for k in range(8)) == 1
    assert sum(1 for r in kept if not (r["text"] or "").split()) == 1 and len(kept) == 62


def test_cell_tree_joins_what_chains_of_short_steps_join():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 40, 150):
        points = rng.integers(0, 1 << 12, size, dtype=np.uint64)
        first, second = simhash.cell_tree(points, 6)
        assert len(first) < size and all(simhash.distances(points[a], points[b : b + 1])[0] <= 6 for a, b in zip(first, second))
        label = np.arange(size)
        for a, b in zip(first, second):
            label[label == label[b]] = label[a]
        for a in range(size):
            near = simhash.distances(points[a], points) <= simhash.CLOSE
            assert len(set(label[near])) == 1


def test_similarity_of_kept_texts_is_exact(spark):
    rng = random.Random(8)
    base = prose(rng, 104).split()  # 100 shingles; each word changed apart from others takes five

    def changed(*at):
        return " ".join("other" + w if i in at else w for i, w in enumerate(base))

    docs = [(1, " ".join(base), "a"), (2, changed(50), "a"), (3, changed(10, 30, 50, 70), "a"), (4, prose(rng, 104), "a")]
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(table(spark, docs)).collect()}
    assert kept == {1, 3, 4}  # 95 of 105 shingles are shared by 1 and 2, 80 of 120 by 1 and 3
    apart = simhash.similar_links(
        spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 3)], "a long, b long"),
        lambda asked: spark.createDataFrame([(i, t) for i, t, _ in docs], "node long, text string").join(asked, "node", "left_semi"),
    )
    assert {tuple(r) for r in apart.collect()} == {(1, 2)}


def test_copies_with_appended_and_cut_blocks_meet(spark):
    rng = random.Random(21)
    docs, want = [], set()
    for k in range(40):
        words = prose(rng, rng.randint(100, 400)).split()
        block = len(words) // 6  # a seventh of the union at most
        other = " ".join(words) + " " + prose(rng, block) if k % 2 else " ".join(words[block:])
        docs += [(2 * k, " ".join(words), "a"), (2 * k + 1, other, "a")]
        want.add(2 * k)
    kept = [r["doc_id"] for r in simhash.keep_one_of_each(table(spark, docs)).collect()]
    assert sorted(kept) == sorted(want)


def test_no_pair_of_a_large_cell_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART_ROWS", 3)
    rng = random.Random(5)
    docs = []
    for g in range(5):
        base = prose(rng, 104).split()
        for k in range(40):  # pairs on both sides of 0.8, in cells above SMALL_CELL
            at = rng.sample(range(4, 100), rng.choice([2, 3, 4]))
            docs.append((100 * g + k, " ".join(f"x{k}" + w if i in at else w for i, w in enumerate(base)), "a"))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((d[0], d[1].split()) for d in docs)}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(table(spark, docs)).collect()}
    assert kept == set(root.values()) and len(kept) > 5


def test_members_a_tree_left_apart_are_paired():
    import pyarrow as pa

    count = simhash.SMALL_CELL + 4
    node, flat = np.arange(count), np.full(count, 100, dtype=np.int32)
    cell = {"key": np.zeros(count, dtype=np.int64), "node": node, "point": 1 << node}
    rows = pa.RecordBatch.from_pydict({**cell, "cell": cell["key"], "size": flat, "place": 0 * flat, "salted": np.zeros(count, dtype=bool)})
    met = [r for b in simhash._prefix_cells(iter([rows])) for r in b.to_pylist()]
    tree = {(r["node"], r["other"]) for r in met if r["other"] is not None}
    assert len(tree) < count and sorted(r["node"] for r in met if r["other"] is None) == node.tolist()
    root = np.where(node < 3, 0, node)  # what the checks of the tree's pairs joined
    bits = [simhash.bitmap(np.arange(100, dtype=np.uint64))] * count
    rows = pa.RecordBatch.from_pydict({"key": cell["key"], "node": node, "root": root, "size": flat, "place": 0 * flat, "bits": bits})
    rest = {(r["node"], r["other"]) for b in simhash._rest_of_cells(False)(iter([rows])) for r in b.to_pylist()}
    assert rest == {(a, b) for a in range(count) for b in range(a + 1, count) if b >= 3}
    near = {(r["node"], r["other"]) for b in simhash._rest_of_cells(True)(iter([rows])) for r in b.to_pylist()}
    assert near < rest and {x for pair in near for x in pair} == set(range(count)) and len(near) <= simhash.NEAREST * count


def test_templates_catch_changed_numbers_and_names(spark):
    item = "A train leaves the old station with Alice at 12,5 km and meets Bob after 3 hours on the long northern line"
    other = "the water in every river of that land ran very low through all of the dry summer months of last year"
    docs = [
        (1, f"Some words first. {item}. And more"), (2, item.replace("12,5", "99").replace("3", "41").replace("Alice", "Maria")),
        (3, "a train leaves nobody behind"), (4, None), (5, ""), (None, item), (6, item.upper()), (7, other),
        (8, "A train leaves the old station"), (1, f"Some words first. {item}. And more"),
    ]
    docs = [(i, t, "s") for i, t in docs]
    bench = spark.createDataFrame([(10, item), (10, item), (11, None), (12, "the of and"), (13, "five words make one window")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contaminated_items(table(spark, docs), bench).collect()}
    assert {1, 2, None} <= set(got) <= {1, 2, None, 6} and got[1]["changed_slots"] == 0 and got[2]["changed_slots"] > 0
    kept = decontaminate.drop_contaminated(table(spark, docs), bench)
    assert {3, 4, 5, 7, 8} <= {r["doc_id"] for r in kept.collect()} and kept.where("doc_id IN (1, 2)").count() == 0


def test_inconsistent_slots_do_not_count(spark):
    item = "take 5 apples and then 5 more apples from the basket so that 5 are left for you"
    twisted = "take 7 apples and then 8 more apples from the basket so that 9 are left for you"
    steady = "take 7 apples and then 7 more apples from the basket so that 7 are left for you"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contaminated_items(table(spark, [(1, twisted, "s"), (2, steady, "s")]), bench).collect()
    assert [r["doc_id"] for r in got] == [2]


def held(spark, item, *texts):
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = table(spark, [(k, t, "s") for k, t in enumerate(texts)])
    return {r["doc_id"] for r in decontaminate.contaminated_items(docs, bench).collect()}


def test_items_dense_in_slots_and_short_items_are_held(spark):
    item = "Which American-born Sinclair won the Nobel Prize for Literature in 1930?"
    assert held(spark, item, f"He asked: {item} And left", "Which prize did Sinclair win in 1930?") == {0}
    assert held(spark, "Name four moons", "so name four moons, please", "name three moons") == {0}


def test_case_and_context_do_not_decide(spark):
    item = "What is the capital city of Peru?"
    assert held(spark, item, f"Question: {item}", item.upper(), item.lower(), item.title(), "What is it of Peru?") == {0, 1, 2, 3}
    item = "Alice walks to the old market every day. Alice then sells bread there until the evening"
    assert held(spark, item, item.replace("Alice", "Maria"), item.replace("Alice", "walks")) == {0}


def test_other_numerals_are_slots_in_every_text(spark):
    item = "the sum of x² and ½ of the other side is taken from all Ⅳ parts of the whole"
    assert held(spark, item, f"{item} on page 7", item.replace("²", "³").replace("½", "¼")) == {0, 1}


def test_one_conflicting_slot_drops_only_its_windows(spark):
    rng = random.Random(2)
    words = prose(rng, 120).split()
    for at in (10, 60, 110):
        words[at] = "77"
    twisted = list(words)
    twisted[60] = "78"
    assert held(spark, " ".join(words), " ".join(twisted)) == {0}


def test_leaks_in_the_documents_are_found(spark, sf):
    import re

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    words = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if words(i["text"]) in words(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_decontaminate(spark, sf).collect()}
    assert want and want <= got and len(got) <= len(want) + 2


def test_urls_by_dates(spark):
    import datetime as dt

    day = lambda d: dt.date(2024, 1, d)
    entries = spark.createDataFrame(
        [
            ("h:x.org", "block", "add", day(5)), ("h:x.org", "block", "remove", day(9)), ("h:x.org", "block", "add", day(9)),
            ("u:a.x.org/ok", "allow", "add", day(6)), (None, "block", "add", day(1)), ("h:y.org", "block", "add", None),
        ],
        "key string, verdict string, action string, listed_on date",
    )
    rows = [
        (1, "http://a.x.org/p?q", day(4)), (1, "http://a.x.org/p?q", day(5)), (2, "https://A.X.org:80/ok#f", day(6)), (3, "http://x.org", day(8)),
        (4, "http://x.org/", day(9)), (5, None, day(6)), (6, "nonsense", day(6)), (None, "http://xx.org/", day(6)), (7, "http://x.org/", None),
    ]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on date")
    got = Counter((r["page_id"], r["fetched_on"], r["verdict"]) for r in url_filter.judge_captures(captures, entries).collect())
    blocked = {(1, day(5)), (3, day(8))}
    assert got == Counter((p, d, "block" if (p, d) in blocked else "allow") for p, _, d in rows)


def test_pipeline_keeps_columns_and_runs_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf).collect()
    assert out and set(out[0].asDict()) == {*docs.columns, "shard", "slot"}
    bad = {r["doc_id"] for r in queries.op10_quality_rules(spark, sf).where("NOT kept").collect()}
    bad |= {r["doc_id"] for r in queries.op1_decontaminate(spark, sf).collect()}
    assert not bad & {r["doc_id"] for r in out}
    assert max(Counter(r["doc_id"] for r in out).values()) <= 3


def test_bitmaps_never_sort_out_a_similar_pair():
    rng = random.Random(6)

    apart = 0
    for _ in range(400):
        count = rng.choice([1, 5, 31, 33, 100, 700])
        a = {rng.getrandbits(64) for _ in range(count)}
        b = set(rng.sample(sorted(a), rng.randint(0, count))) | {rng.getrandbits(64) for _ in range(rng.randint(0, count // 3))} or {1}
        bits = [simhash.bitmap(np.array(sorted(x), dtype=np.uint64)) for x in (a, b)]
        verdict = len(a) + len(b) >= 9 * simhash.differing_bits(bits, np.array([0]), np.array([1]))[0]
        assert verdict or 5 * len(a & b) < 4 * len(a | b)
        apart += not verdict
    assert apart > 100


def test_near_dedup_takes_the_groups_of_the_covering_code(spark, monkeypatch):
    rng = random.Random(8)
    points = [rng.getrandbits(62) for _ in range(6)]
    points += [p ^ 1 << 3 ^ 1 << 40 for p in points[:3]] + [points[3], points[4] ^ 0b111]
    nodes = spark.createDataFrame(list(enumerate(points)), "node long, point long")
    assert sorted(map(tuple, simhash.anchored_links(nodes).collect())) == [(0, 6), (1, 7), (2, 8), (3, 9)]

    seen, links = [], simhash.similar_links
    monkeypatch.setattr(simhash, "similar_links", lambda pairs, texts: seen.append(pairs.count()) or links(pairs, texts))
    base = prose(rng, 400).split()
    docs = [(k, " ".join([*base[:-1], f"end{k}"]), "a") for k in range(6)] + [(9, prose(rng, 400), "a")]
    assert sorted(r["doc_id"] for r in simhash.keep_one_of_each(table(spark, docs)).collect()) == [0, 9]
    assert len(seen) == 2 and seen[0] > 0 and seen[1] < 15, "groups of close fingerprints first, then pairs between groups"
