"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledgercast.llm import queries, spelling


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(docs):
    counts = Counter()
    lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    for doc_id, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            counts[word if h % 199 else word[: h % len(word)] + word[h % len(word) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if distance(w, v) == 1] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def documents():
    rng = random.Random(12)
    letters = "abcdeéÈÿA×ÀZ"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 12))) for _ in range(60)]
    pool = []
    for base in bases:
        pool += [base] * rng.choice([6, 40, 300])
        for _ in range(4):
            word = base
            for _ in range(rng.randint(1, 2)):
                at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
                word = word[:at] + (rng.choice(letters) if kind else "") + word[at + (kind != 1) :]
            pool += [word] * rng.choice([1, 5, 7, 30])
    rng.shuffle(pool)
    docs = [(k, " ".join(pool[k * 40 : k * 40 + 40]) + rng.choice(["", ".", "\n7x"])) for k in range(len(pool) // 40 + 1)]
    return docs + [(None, "abcdefgh " * 300), (None, None), (1, ""), (2, "word" * 3000), (2, "abcdefghi " * 20), (2, "abcdefghi " * 20)]


@pytest.mark.parametrize("part", [4096, 3])
def test_variants_match_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "PART_ROWS", part)
    monkeypatch.setattr(spelling, "TILE", 1024 if part > 3 else 2)
    docs = documents()
    table = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, word string, n long")
    got = sorted([tuple(r) for r in spelling.spelling_variants(table, queries.misspelt).collect()], key=str)
    want = brute(docs)
    assert got == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1]) and len(want) > 80


def test_one_edit_is_a_distance_of_one():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(2))
        assert spelling.one_edit(a, b) == (distance(a, b) == 1)


def test_empty_tables(spark):
    empty = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert spelling.spelling_variants(empty).collect() == [] and spelling.spelling_variants(empty.limit(0)).collect() == []


def test_the_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in queries.op12_spelling_variants(spark, sf).collect()], key=str)
    assert got == brute(docs) and got
