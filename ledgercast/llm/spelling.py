"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Words are counted over all texts. Two words one insertion, deletion or replacement apart agree in the first half or in the
last half of the shorter one, so each word goes to the blocks of its halves, for its own length and the one
below. In a block of adjacent lengths, products of letter counts give all squared distances at once; one
edit leaves two at most, and what is that near is verified letter by letter. A pair is taken in the
block of the first half, in that of the last half only if the first halves differ, so it is found once.
Blocks above ``PART_ROWS`` words are dealt in parts, and two parts meet in a block of their own.

Null texts hold no words. Counts grow with the corpus and travel once per word, task and flush; all further
work is on the vocabulary of words that are long and frequent enough. Letters other than A-Z keep their case.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgercast.llm.simhash import _pieces
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = np.concatenate([np.arange(ord("a"), ord("z") + 1), np.arange(0xC0, 0x100)])
COLUMN = np.full(0x100, 0, dtype=np.int64)
COLUMN[LETTERS] = np.arange(len(LETTERS))
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
FLUSH = 200_000
PART_ROWS = 4096
TILE = 1024
BROADCAST_BLOCKS = 100_000


def _count(change: Callable[[object, str], str] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["word", "n"])
            totals.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # bytes know ASCII letters only
                lowered = (text.as_py() or "").encode().lower().decode()
                for word in RUN.findall(lowered):
                    if change:
                        word = change(doc_id, word)
                    if len(word) >= LEAST_LETTERS:
                        totals[word] = totals.get(word, 0) + 1
                if len(totals) >= FLUSH:
                    yield flushed()
        if totals:
            yield flushed()

    return counted


def vocabulary(docs: DataFrame, change: Callable[[object, str], str] | None = None) -> DataFrame:
    """``word, n``: words of ``LEAST_LETTERS`` letters or more that occur ``LEAST_COUNT`` times or more in all texts.

    ``change`` (doc_id, word) may give another word in the place of one.
    """
    partial = docs.select("doc_id", "text").mapInArrow(_count(change), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def letter_counts(words: list[str]) -> np.ndarray:
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    out = np.zeros((len(words), len(LETTERS)), dtype=np.float32)
    np.add.at(out, (row, COLUMN[letters]), 1)
    return out


def near_pairs(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of words whose letter counts are at most two apart in square and whose lengths are
    adjacent, tile by tile."""
    counts = letter_counts(words)
    squares = (counts * counts).sum(axis=1)
    lengths = np.array([len(w) for w in words])
    for top in range(0, len(words), TILE):
        for left in range(top, len(words), TILE):
            a, b = slice(top, top + TILE), slice(left, left + TILE)
            distance = squares[a][:, None] + squares[b][None, :] - 2 * (counts[a] @ counts[b].T)
            close = (distance <= 2) & (np.abs(lengths[a][:, None] - lengths[b][None, :]) <= 1)
            i, j = np.nonzero(close)
            later = left + j > top + i
            yield top + i[later], left + j[later]


PAIRS = "a string, n_a long, b string, n_b long"


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart of every block. A block's rows have one key; keys that collide are told apart."""
    for keys, words, n, tail, shorter, part, diagonal in _pieces(batches, 7):
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        first, second = [], []
        for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            here = slice(start, start + size)
            names = words[here].tolist()
            for a, b in near_pairs(names):
                for i, j in zip((start + a).tolist(), (start + b).tolist()):
                    x, y, half = words[i], words[j], shorter[i] // 2
                    if tail[i] != tail[j] or shorter[i] != shorter[j] or min(len(x), len(y)) != shorter[i]:
                        continue
                    if not diagonal[i] and part[i] == part[j]:
                        continue
                    if (x[:half] == y[:half]) != tail[i] and one_edit(x, y):
                        first.append(i)
                        second.append(j)
        if first:
            columns = [pa.array(words[first], pa.string()), pa.array(n[first], pa.int64()), pa.array(words[second], pa.string()), pa.array(n[second], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "n_a", "b", "n_b"])


def variant_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of ``words`` (``word, n``) that is one edit apart, once."""
    spark = words.sparkSession
    length, half = F.char_length("word"), F.floor(F.col("shorter") / 2).cast("int")
    roles = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("shorter")).where(F.col("shorter") >= LEAST_LETTERS)
    halves = roles.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("tail"))
    stretch = F.when(F.col("tail"), F.expr("right(word, shorter - int(shorter div 2))")).otherwise(F.substring("word", F.lit(1), half))
    members = halves.withColumn("key", F.xxhash64("tail", "shorter", stretch))
    large = members.groupBy("key").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts")).where("parts > 1")
    large = staged(large, stage_path(spark, "blocks"))
    large = F.broadcast(large) if large.count() <= BROADCAST_BLOCKS else large
    parts = F.coalesce("parts", F.lit(1))
    dealt = members.join(large, "key", "left").withColumn("part", F.pmod(F.xxhash64("word"), parts))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    block = F.when(parts > 1, F.xxhash64("key", F.least("part", "with"), F.greatest("part", "with"))).otherwise(F.col("key"))
    keyed = dealt.select(block.alias("key"), "word", "n", "tail", "shorter", "part", (F.col("part") == F.col("with")).alias("diagonal"))
    # In the block of two parts either part's rows are off the diagonal.
    return keyed.repartition("key").sortWithinPartitions("key", "word").mapInArrow(_verified, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the steps from word to form end, for words that have a form.

    A form is at least ``RATIO`` times as frequent as its word, so chains are short and end; each round doubles the step.
    """
    spark = forms.sparkSession
    current = staged(forms.select("word", F.col("form").alias("root")), stage_path(spark, "roots"))
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = current.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        stepped = staged(stepped, stage_path(spark, "roots"))
        current = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return current


def spelling_variants(docs: DataFrame, change: Callable[[object, str], str] | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary.

    ``form`` is the most frequent word one edit away (ties: the smallest) if it is at least ``RATIO`` times as
    frequent, ``root`` where the steps from form to form end, the word itself if it has none.
    """
    spark = docs.sparkSession
    words = staged(vocabulary(docs, change), stage_path(spark, "words"))
    pairs = staged(variant_pairs(words), stage_path(spark, "variants"))
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a"))
    )
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = sides.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    chosen = form_n >= RATIO * F.col("n")
    known = known.select(
        "word", F.when(chosen, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, form_n).alias("form_n"),
    )
    known = staged(known, stage_path(spark, "forms"))
    ended = roots(known.where("form IS NOT NULL"))
    return known.join(ended, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
