"""Repeated byte strings, by a logarithmic family of sparse suffix indexes.

A suffix is sampled where the hash of its first 200 bytes is the smallest around: every 400-byte
string holds a sampled suffix with at least 200 of its bytes, and equal strings hold equal ones.
Neighbouring starts with the same smallest suffix form a run; the run's text is all their strings
together. A level of the index is a table of runs in order of suffix hash: (suffix, run, n). A new
batch gets such a table, is merge-scanned against the levels there are for suffixes in common, and
becomes a level; levels of equal size merge before the next batch comes, so a batch never meets more
than log2 of them, and levels that no batch will meet are not written again.

A run seen twice is repeated as a whole. A run seen once whose suffix occurs in other runs agrees
with them only in part. Such runs are cut again by suffixes of all but a few bytes of a string and
judged in the same way; most parts are then seen twice as a whole or share nothing. Of the parts left,
at the ends of what agrees, the 400-byte strings are hashed one by one and counted. A count is
an aggregation with map-side combine, so a passage in a third of all documents is one row per task.

Matches never cross documents. Null texts are empty. Equal texts are all copies of each other. The
verdict depends on a text only, so rows with the same text share it. Texts and strings are compared
by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgercast.llm.rolling import all_of_length, running, sliding, stretches
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

LENGTH = 400
SUFFIX = 200
STEP = 24  # bytes of a string beyond the suffixes of the second cut
BATCHES = 4
TOGETHER = 1 << 20
BROADCAST_ITEMS = 400_000


def byte_groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a megabyte together; a longer text is alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > TOGETHER:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def runs_of(texts: list[bytes], length: int, suffix: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: text number, start, number of starts, suffix, run hash of each run, and
    how often the suffix stands in the run."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    firsts = np.cumsum(sizes) - sizes
    room = np.maximum(0, sizes - length + 1)
    if not room.sum():
        return tuple(np.empty(0, dtype=np.int64) for _ in range(6))
    sums = running(data)
    hashes = all_of_length(sums, suffix)
    width = length - suffix + 1
    every = sliding(np.minimum, hashes, width)
    owner = np.repeat(np.arange(len(texts)), room)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(room) - room, room)
    least = every[firsts[owner] + starts]
    fresh = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])])
    counts = np.diff(np.r_[fresh, len(owner)])
    at, key = firsts[owner[fresh]] + starts[fresh], least[fresh]
    run = stretches(sums, at, at + counts + length - 1)
    # Places that are the smallest of some string around them, by value and place.
    edge = np.zeros(width - 1, dtype=np.uint64)
    places = np.flatnonzero(sliding(np.maximum, np.concatenate([edge, every, edge]), width) == hashes)
    values, number = np.unique(hashes[places], return_inverse=True)
    sorted_places = np.sort(number * len(data) + places)
    first_place = np.searchsorted(values, key) * len(data) + at
    inside = np.searchsorted(sorted_places, first_place + counts + width - 1) - np.searchsorted(sorted_places, first_place)
    return owner[fresh], starts[fresh], counts, key.view(np.int64), run.view(np.int64), inside


RUNS = "suffix long, run long, text_id long, start int, starts int, n long, loops boolean"


def _runs(length: int, suffix: int):
    """Runs of ``text, text_id``, or of the stretches ``wanted`` of each text, with their weights."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            if batch.num_columns > 2:
                wanted = batch.column(2).to_pylist()
                ids = np.repeat(ids, [len(stretch) for stretch in wanted])
                texts = [memoryview(t)[w["start"] : w["start"] + w["starts"] - 1 + length] for t, ws in zip(texts, wanted) for w in ws]
                begin, weight = (np.array([w[k] for ws in wanted for w in ws], dtype=np.int64) for k in ("start", "n"))
            else:
                begin, weight = np.zeros(len(texts), dtype=np.int64), np.ones(len(texts), dtype=np.int64)
            for low, high in byte_groups(texts):
                owner, starts, counts, key, run, inside = runs_of(texts[low:high], length, suffix)
                starts = (starts + begin[low:high][owner]).astype(np.int32)
                columns = [key, run, ids[low:high][owner], starts, counts.astype(np.int32), weight[low:high][owner], inside > 1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["suffix", "run", "text_id", "start", "starts", "n", "loops"])

    return runs


class SuffixIndex:
    """Levels of ``(suffix, run, n)`` tables, each with the number of batches in it."""

    def __init__(self, spark):
        self.spark = spark
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, runs: DataFrame) -> DataFrame:
        """Take a batch in; ``suffix`` of its runs that occurs twice in it, or in it and any level."""
        self._merge()
        batch = runs.groupBy("suffix", "run").agg(F.sum("n").alias("n"), F.max("loops").alias("loops"))
        batch = staged(batch.sortWithinPartitions("suffix"), stage_path(self.spark, "level"))
        found = batch.groupBy("suffix").agg(F.sum("n").alias("n"), F.max("loops").alias("loops")).where("n > 1 OR loops").select("suffix")
        for _, level in self.levels:
            found = found.union(batch.join(level.select("suffix"), "suffix", "left_semi").select("suffix"))
        self.levels.append((1, batch))
        return staged(found.distinct(), stage_path(self.spark, "found"))

    def _merge(self) -> None:
        """Levels of equal size become one, all that meet in one writing."""
        size, number = 0, 0
        while number < len(self.levels) and self.levels[-1 - number][0] == (size or 1):
            size += self.levels[-1 - number][0]
            number += 1
        if number > 1:
            both = self.levels[-1][1]
            for _, level in self.levels[-number:-1]:
                both = both.union(level)
            both = both.groupBy("suffix", "run").agg(F.sum("n").alias("n"), F.max("loops").alias("loops"))
            self.levels[-number:] = [(size, staged(both.sortWithinPartitions("suffix"), stage_path(self.spark, "level")))]

    def runs(self, found: DataFrame) -> DataFrame:
        """All runs of the suffixes found, with their numbers of occurrences: dealt by suffix once."""
        every = self.levels[0][1]
        for _, level in self.levels[1:]:
            every = every.union(level)
        met = every.select("suffix", "run", "n").join(found, "suffix", "left_semi")
        return met.groupBy("suffix", "run").agg(F.sum("n").alias("n"))


STRINGS = "string long, n long, text_id long, start int, end int"


def strings_of(hashes: np.ndarray, weight: np.ndarray, ids: np.ndarray, at: np.ndarray, length: int) -> pa.RecordBatch:
    """Rows of ``STRINGS`` for strings read together.

    A string met once is a row with its place. Of one met several times, and so repeated, the total is a row
    without a place, and the places are rows without a string, neighbours together.
    """
    values, number = np.unique(hashes, return_inverse=True)
    total = np.zeros(len(values), dtype=np.int64)
    np.add.at(total, number, weight)
    often = np.bincount(number, minlength=len(values)) > 1
    once = np.flatnonzero(~often[number])
    places = np.flatnonzero(often[number] & (weight == 1))
    first = np.r_[True, (np.diff(at[places]) != 1) | (np.diff(ids[places]) != 0)][: len(places)]
    last = np.r_[first[1:], True][: len(places)]
    opened, closed = places[first], places[last]
    none = [pa.nulls(k, pa.int64()) for k in (often.sum(), len(opened))]
    columns = [
        [pa.array(hashes[once]), pa.array(values[often]), none[1]],
        [pa.array(weight[once]), pa.array(total[often]), none[1]],
        [pa.array(ids[once]), none[0], pa.array(ids[opened])],
        [pa.array(at[once]), none[0].cast(pa.int32()), pa.array(at[opened])],
        [pa.array(at[once] + np.int32(length)), none[0].cast(pa.int32()), pa.array(at[closed] + np.int32(length))],
    ]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], ["string", "n", "text_id", "start", "end"])


def _strings(length: int):
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, size = [], 0
        for batch in batches:
            for text, text_id, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                hashes = all_of_length(running(np.frombuffer(text, dtype=np.uint8)), length).view(np.int64)
                at = np.concatenate([np.arange(w["start"], w["start"] + w["starts"], dtype=np.int32) for w in wanted])
                weight = np.concatenate([np.full(w["starts"], w["n"], dtype=np.int64) for w in wanted])
                read.append((hashes[at], weight, np.full(len(at), text_id, dtype=np.int64), at))
                size += len(at)
                if size > TOGETHER:
                    yield strings_of(*map(np.concatenate, zip(*read)), length)
                    read, size = [], 0
        if read:
            yield strings_of(*map(np.concatenate, zip(*read)), length)

    return strings


def bounded(rows: DataFrame, items: str) -> DataFrame:
    """A written table, marked for broadcast if all its ``items`` arrays together are short enough."""
    total = rows.agg(F.sum(F.size(items))).first()[0] or 0
    return F.broadcast(rows) if total <= BROADCAST_ITEMS else rows


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("text_id"), F.length("text").cast("long").alias("n_bytes")
    )


def union_of_ranges(ranges: DataFrame) -> DataFrame:
    """``text_id, spans``: the union of the ranges ``text_id, start, end`` as sorted, separate spans."""
    by_start = Window.partitionBy("text_id").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("opens", F.when(F.col("start") <= reached, 0).otherwise(1))
    numbered = opened.withColumn("span", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("text_id", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def judged(runs: DataFrame, batches: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Ranges ``text_id, start, end`` of the runs seen twice, and ``text_id, wanted``: where to read the runs
    whose suffix has a run seen only once, one occurrence of each."""
    spark = runs.sparkSession
    index, found = SuffixIndex(spark), None
    for batch in range(batches):
        hits = index.add(runs.where(F.pmod(F.col("text_id"), F.lit(batches)) == batch))
        found = hits if found is None else found.union(hits)
    known = staged(index.runs(found.distinct()), stage_path(spark, "known"))
    met = staged(runs.drop("n", "loops").join(known, ["suffix", "run"]), stage_path(spark, "met"))

    end_of_run = (F.col("start") + F.col("starts") - 1 + length).alias("end")
    whole = met.where("n > 1").select("text_id", "start", end_of_run).distinct()
    unsure = known.where("n = 1").select("suffix").distinct()
    asked = met.join(unsure, "suffix", "left_semi").groupBy("suffix", "run").agg(
        F.first("n").alias("n"), F.min(F.struct("text_id", "start", "starts")).alias("p")
    )
    asked = asked.groupBy("p.text_id").agg(F.collect_list(F.struct("p.start", "p.starts", "n")).alias("wanted"))
    return whole, staged(asked, stage_path(spark, "asked"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, suffix: int = SUFFIX, batches: int = BATCHES) -> DataFrame:
    """``text_id, spans`` of distinct texts: sorted (start, end) byte ranges that lie apart."""
    spark = docs.sparkSession
    texts = texts_of(docs)
    long_enough = texts.where(F.col("n_bytes") >= length)
    runs = staged(long_enough.select("text", "text_id").mapInArrow(_runs(length, suffix), RUNS), stage_path(spark, "runs"))
    whole, asked = judged(runs, batches, length)

    sources = texts.select("text", "text_id").join(bounded(asked, "wanted"), "text_id").groupBy("text_id").agg(
        F.first("text").alias("text"), F.first("wanted").alias("wanted")
    )
    sources = staged(sources.select("text", "text_id", "wanted"), stage_path(spark, "sources"))
    parts = staged(sources.mapInArrow(_runs(length, max(suffix, length - STEP)), RUNS), stage_path(spark, "parts"))
    whole_parts, asked = judged(parts, 1, length)
    asked_again = sources.select("text", "text_id").join(bounded(asked, "wanted"), "text_id")
    strings = staged(
        asked_again.select("text", "text_id", "wanted").mapInArrow(_strings(length), STRINGS), stage_path(spark, "strings")
    )
    twice = strings.where("string IS NOT NULL").groupBy("string").agg(F.sum("n").alias("total")).where("total > 1").select("string")
    single = strings.where("n = 1").join(twice, "string", "left_semi")
    ranges = whole.union(whole_parts)
    for more in (strings.where("string IS NULL"), single):
        ranges = ranges.union(more.select("text_id", "start", "end"))
    return union_of_ranges(ranges)


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, count, digest = [], [], []
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            spans = [(span["start"], span["end"]) for span in spans or ()]
            kept = cut(text, spans)
            removed.append(len(text) - len(kept))
            count.append(len(spans))
            digest.append(hashlib.sha256(kept).hexdigest())
        columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame, length: int = LENGTH, suffix: int = SUFFIX, batches: int = BATCHES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, a row per row of ``docs``."""
    spans = staged(repeated_spans(docs, length, suffix, batches), stage_path(docs.sparkSession, "spans"))
    joined = texts_of(docs).join(bounded(spans, "spans"), "text_id", "left").select("doc_id", "n_bytes", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_cut_rows, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
