"""Periodic runs against every stretch of short texts, and the query's digests from plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgercast.llm import periodic, queries


def brute(words):
    """All runs by trying every start, end and period."""
    found = set()
    count = len(words)
    for q in range(1, count // 4 + 1):
        start = 0
        while start + q < count:
            end = start
            while end + q < count and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            stretch = words[start : start + length]
            if end > start and length >= max(6, 4 * q):
                if not any(all(stretch[i] == stretch[i + p] for i in range(length - p)) for p in range(1, q)):
                    found.add((start, length, q))
            start = max(end, start) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def text_of(rng):
    parts = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice("abcdefg") for _ in range(rng.randint(1, 6))]
        parts += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))]
        parts += [rng.choice("abcxyz") for _ in range(rng.randint(0, 3))]
    return parts


def test_runs_match_every_stretch():
    rng = random.Random(4)
    some = 0
    for _ in range(1500):
        words = text_of(rng)
        ids = np.array([ord(w) for w in words], dtype=np.int64)
        got = [tuple(r) for r in periodic.periodic_runs(ids).tolist()]
        assert got == brute(words), words
        some += len(got) > 1
    assert some > 200


def test_segments_hold_every_run_and_split_the_rest():
    ids = np.array([1, 2, 1, 2, 1, 2, 1, 2, 9, 1, 2, 3, 1, 2, 3, 5, 5, 5, 5, 5, 5])
    assert periodic.frequent_segments(ids).tolist() == [True] * 8 + [False] * 7 + [True] * 6


def digest(doc_id, text):
    words = (text or "").split() if text is None or text.isascii() else None
    count = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and count:
        a = g % count
        p = 1 + (count - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, count)]
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_digests_match_plain_python(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(text_of(rng))) for i in range(300)] + [(700, None), (701, ""), (702, " \n\t "), (3, "a b"), (3, "a b"), (-5, "x " * 30)]
    docs += [(i, " ".join(rng.choice("abcdefghij") for _ in range(90))) for i in range(800, 900)]
    table = spark.createDataFrame([(i, t, 1, "clash") for i, t in docs], "doc_id long, text string, runs long, collapsed string")
    got = [tuple(r) for r in queries.run_digest(table).select(*COLUMNS).collect()]
    assert sorted(got, key=str) == sorted([digest(i, t) for i, t in docs], key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs) > 10


def test_null_ids_and_empty_table(spark):
    table = spark.createDataFrame([(None, "a a a a a a a")], "doc_id long, text string")
    row = queries.run_digest(table).first()
    assert row["n_runs"] == 1 and row["length"] == 7 and row["exponent_milli"] == 7000
    assert queries.run_digest(table.limit(0)).collect() == []


@pytest.mark.parametrize("unit", [1, 7, 30_000])
def test_long_texts(unit):
    ids = np.tile(np.arange(unit), 300_000 // unit)
    assert periodic.periodic_runs(ids).tolist() == [[0, len(ids), unit]]


def test_words_of_other_texts_never_meet():
    texts = [["a"] * 4, ["a"] * 4, ["a"] * 9]
    out = list(periodic._texts([[w.encode() for w in t] for t in texts]))
    assert [len(r) for r, _ in out] == [0, 0, 1] and out[2] == ([{"start": 0, "length": 9, "period": 1}], "a")
