"""Substring dedup, language-model scores and token files against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgercast import session
from ledgercast.llm import lm_score, queries, substring_dedup, token_files, token_prefix
from ledgercast.llm.vocabulary import word_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, start long, n long, part int"


def table(spark, rows):
    """Documents with extra columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, "en", "s", 7, 8, 9) for i, t in rows], SCHEMA)


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage = prose(rng, 40)
    out = [(i, prose(rng, rng.randint(1, 60))) for i in range(25)]
    out += [(100 + i, prose(rng, 12) + " " + passage + " " + prose(rng, 9)) for i in range(6)]
    out += [(200, out[3][1]), (200, out[3][1]), (None, "Straße naïve ÉTÉ don't 12,5 a.b"), (None, None), (301, ""), (302, " \n\t ")]
    out += [(303, "a" * 900), (304, "ab" * 300), (305, prose(rng, 3000)), (306, passage * 2), (307, "<|endoftext|> x 中文  y")]
    return out


def brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(r, dtype=np.uint8)[~gone])
        spans = int((gone & ~np.r_[False, gone[:-1]][: len(gone)]).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, suffix", [(60, 30), (400, 200)])
def test_removed_bytes_equal_brute_force(spark, rows, length, suffix):
    got = substring_dedup.without_repeats(table(spark, rows), length, suffix).collect()
    want = Counter(zip([i for i, _ in rows], brute_removed([t for _, t in rows], length)))
    assert Counter((r[0], tuple(r[1:])) for r in got) == want


def test_removed_bytes_without_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BROADCAST_ITEMS", -1)
    got = substring_dedup.without_repeats(table(spark, rows), 60, 30).collect()
    assert Counter((r[0], tuple(r[1:])) for r in got) == Counter(zip([i for i, _ in rows], brute_removed([t for _, t in rows], 60)))


def test_passages_that_agree_in_part_are_few_ranges(spark, monkeypatch):
    rng = random.Random(11)
    passage = prose(rng, 700)
    texts = [prose(rng, 70) + passage[: 1500 + 40 * i] + "#" + passage[1500 + 40 * i :] + prose(rng, 70) for i in range(8)]
    texts += ["abcd " * 300, "x " + "abcd " * 200 + "y"]
    ranges = []
    union = substring_dedup.union_of_ranges
    monkeypatch.setattr(substring_dedup, "union_of_ranges", lambda df: ranges.append(df.count()) or union(df))
    docs = table(spark, list(enumerate(texts)))
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.without_repeats(docs).collect()}
    want = brute_removed(texts, 400)
    assert got == dict(enumerate(want))
    assert sum(w[1] for w in want) > 20_000 and ranges[0] < 1000


def test_index_is_not_merged_for_no_batch(spark, rows):
    docs = substring_dedup.texts_of(table(spark, rows)).where("n_bytes >= 60").select("text", "text_id")
    schema = "suffix long, run long, text_id long, start int, starts int, n long, loops boolean"
    runs = docs.mapInArrow(substring_dedup._runs(60, 30), schema).cache()
    index, sizes = substring_dedup.SuffixIndex(spark), []
    for part in range(7):
        index.add(runs.where(f"pmod(text_id, 7) = {part}"))
        sizes.append([size for size, _ in index.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1], [4, 2, 1]]


def test_removed_bytes_of_the_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in queries.op4_substring_dedup(spark, sf).collect()}
    assert got == dict(zip([d[0] for d in docs], brute_removed([d[1] for d in docs], 400)))


def test_empty_tables(spark):
    empty = table(spark, [])
    assert substring_dedup.without_repeats(empty).count() == 0
    assert lm_score.score_documents(empty).count() == 0
    path = queries.vocabulary_path()
    assert token_files.token_digest(empty, path).count() == 0
    assert token_prefix.prefix_table(empty, path).count() == 0


# -- language model ------------------------------------------------------------------------------


def tokens_of(text):
    return [w.decode("utf-8") for w in (text or "").encode().lower().split()] + [None]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check_scores(got, rows):
    train = [tokens_of(t) for i, t in rows if not is_held(i)]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([None] + t[:-1], t))
    total, kinds = sum(count.values()), len(count)
    p1 = lambda w: (count[w] + 1) / (total + kinds + 1)
    want = Counter()
    scores = {}
    for i, t in rows:
        tokens = tokens_of(t)
        base = sum(math.log10(p1(w)) for w in tokens)
        model = 0.0
        for u, w in zip([None] + tokens[:-1], tokens):
            g = count[u] / (count[u] + 4.0)
            q = 2 ** int(math.log2(pairs[u, w])) if pairs[u, w] else 0
            model += math.log10((g * q / count[u] if count[u] else 0.0) + (1 - g) * p1(w))
        key = (i, is_held(i), len(tokens), sum(count[w] > 0 for w in tokens), total, round(base, 6))
        want[key] += 1
        scores[key] = model
    assert Counter((*r[:5], round(r[5], 6)) for r in got) == want
    errors = [abs(r[6] - scores[(*r[:5], round(r[5], 6))]) / r[2] for r in got]
    assert max(errors) < 0.5 and np.mean(errors) < 0.01  # false positives of the filter


def test_scores_equal_a_dictionary_model(spark, rows):
    check_scores(lm_score.score_documents(table(spark, rows)).collect(), rows)


def test_scores_in_small_chunks(spark, rows, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(lm_score, "SEGMENT_BYTES", 1000)
    check_scores(lm_score.score_documents(table(spark, rows)).collect(), rows)


def test_held_out_texts_score_above_the_base(spark, sf):
    got = queries.op5_lm_score(spark, sf).collect()
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check_scores(got, docs)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_filter_never_undercounts():
    items = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    levels = np.arange(5000) % 7 + 1
    lookup = lm_score.LogFrequencyFilter(items, levels)
    assert (lookup.levels(items) >= levels).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert (lookup.levels(others) > 0).mean() < 0.01


# -- tokens --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def test_prefix_counts_equal_the_library(spark, rows, library):
    got = token_prefix.prefix_table(table(spark, rows), queries.vocabulary_path()).collect()
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert Counter((r[0], r[1], r[2]) for r in got) == Counter((i, len((t or "").encode()), count(t)) for i, t in rows)


def test_budget_questions_without_encoding(library):
    tokenizer = word_tokenizer(queries.vocabulary_path())
    text = "Straße don't  stop,\nthe 12 ouvèles!! end"
    steps = token_prefix.read_steps(token_prefix.prefix_steps(tokenizer, [text])[0].tobytes())
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert token_prefix.tokens_in(steps) == count(text)
    for end, n in steps.tolist():
        assert n == count(text[:end])
    for position in range(len(text) + 1):
        assert token_prefix.tokens_up_to(steps, text, position, tokenizer) == count(text[:position])
    for budget in range(count(text) + 1):
        cut = token_prefix.cut_for_budget(steps, budget)
        assert count(text[:cut]) <= budget


def test_token_query_equals_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: (r[1], r[2], r[3]) for r in queries.op8_token_prefix(spark, sf).collect()}
    counts = {d[0]: len(library.encode(d[1], add_special_tokens=False).ids) for d in docs}
    assert got == {d[0]: (len(d[1].encode()), counts[d[0]], counts[d[0]] > 2048) for d in docs}


def expected_files(rows, library):
    ids = {}
    for i, t in rows:
        one = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        ids.setdefault(i, []).append((t or "", one))
    start, out = 0, Counter()
    for i in sorted(ids, key=lambda k: (k is not None, k)):
        for _, one in sorted(ids[i], key=lambda p: p[0].encode()):
            out[i, start, len(one), zlib.crc32(one.tobytes())] += 1
            start += len(one)
    return out


@pytest.mark.parametrize("block", [8, 65_536])
def test_token_files_round_trip(spark, rows, library, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    monkeypatch.setattr(token_files, "CHECKPOINT", 4 if block == 8 else 512)
    got = token_files.token_digest(table(spark, rows), queries.vocabulary_path()).collect()
    assert Counter(tuple(r) for r in got) == expected_files(rows, library)


def test_token_file_query(spark, sf, library):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in queries.op9_huffman_tokens(spark, sf).collect()) == expected_files(docs, library)


def test_code_lengths_are_limited_and_complete():
    counts = {i: 2**min(i, 40) for i in range(50)} | {100 + i: 1 for i in range(300)}
    lengths = token_files.code_lengths(counts)
    assert max(lengths.values()) <= 16 and sum(2.0**-n for n in lengths.values()) == 1.0
    code = token_files.Code(lengths)
    ids = np.array(list(counts) * 7)
    bits, offsets = code.encode(ids)
    assert (code.decode(bits, offsets, len(ids)) == ids).all()
    only = token_files.Code(token_files.code_lengths({5: 9}))
    assert only.decode(*only.encode(np.array([5, 5])), 2).tolist() == [5, 5]


def test_word_cache_shrinks_without_a_change_of_ids(monkeypatch):
    from ledgercast.llm import vocabulary

    monkeypatch.setattr(vocabulary, "MOST_WORDS", 40)
    tokenizer = vocabulary.WordTokenizer(queries.vocabulary_path())
    common = "the cat sat on don't, mat"
    texts = [f" {common} \n word{i}x{i * 7} àé{i}, {'z' * i}\t" for i in range(60)] + ["", "  ", "日本 a", "<|endoftext|> b"]
    for text in texts:
        ids = vocabulary.encode_many(tokenizer, [text, common])
        assert ids[0].tolist() == tokenizer.whole(text)
        assert ids[1].tolist() == tokenizer.whole(common)
    assert len(tokenizer.index) < 120


def test_hashes_do_not_depend_on_pieces(rows, monkeypatch):
    texts = [(t or "").encode() for _, t in rows]
    whole = lm_score.token_hashes(texts)
    monkeypatch.setattr(lm_score, "PIECE_BYTES", 100)
    lengths, running = [], lm_score.running
    monkeypatch.setattr(lm_score, "running", lambda data: lengths.append(len(data)) or running(data))
    pieces = lm_score.token_hashes(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces))
    assert len(lengths) > 5 and max(lengths) <= max(map(len, texts)) + 101


def test_a_chunk_is_sent_in_two_batches(rows):
    batch = pa.RecordBatch.from_pydict({
        "chunk": ["a", "b"], "held": [[False] * len(rows)] * 2, "texts": [[(t or "").encode() for _, t in rows]] * 2
    })
    sent = list(lm_score._send(40)(iter([batch])))
    assert len(sent) == 4, "words and bigrams of two chunks, whatever the number of segments"
    assert max(b.num_rows for b in sent) == 40


def test_texts_pass_to_python_in_batches_of_a_chunk(spark, rows, monkeypatch):
    seen, write = [], lm_score.staged
    limit = lambda: spark.conf.get(session.ARROW_BYTES)
    monkeypatch.setattr(lm_score, "staged", lambda *a: seen.append(limit()) or write(*a))
    before = limit()
    check_scores(lm_score.score_documents(table(spark, rows)).collect(), rows)
    assert seen == [str(lm_score.CHUNK_BYTES)] and limit() == before
