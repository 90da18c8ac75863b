"""Token-id files in canonical, length-limited Huffman code.

Code lengths come from the counts of all ids (a table no longer than the vocabulary), limited to 16
bits by the package-merge method; canonical codes follow from the lengths alone. A block holds whole
documents, at least one and otherwise up to 262,144 ids, and can be decoded by itself: its row has
the documents' ids and lengths, the bits, and the bit offset of every 512th id, so all stretches
between checkpoints are decoded side by side with one table look-up per id.

Files are Parquet rows on shared storage, ordered by doc_id: documents are dealt to ranges of doc_id
and sorted inside (nulls first). Null texts have no ids but the closing one. Rows with equal ids
stand next to each other, ordered by text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgercast.llm.vocabulary import encode_many, groups_of, word_tokenizer
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged, stage_read, stage_write

END = 2
LONGEST = 16
BLOCK_IDS = 262_144
CHECKPOINT = 512


# -- code ----------------------------------------------------------------------------------------


def code_lengths(counts: dict[int, int], longest: int = LONGEST) -> dict[int, int]:
    """Optimal code lengths of at most ``longest`` bits by package-merge.

    Every round pairs the cheapest packages and merges the pairs with the single ids; an id's length
    is the number of times it is in the first 2n - 2 packages of the last round.
    """
    ids = np.array(sorted(counts), dtype=np.int64)
    if len(ids) < 2:
        return {int(i): 1 for i in ids}
    if len(ids) > 1 << longest:
        raise ValueError("the code is too short for so many ids")
    weight = np.array([counts[int(i)] for i in ids], dtype=np.float64)
    order = np.argsort(weight, kind="stable")
    single = weight[order]
    rounds: list[np.ndarray] = []
    merged = single
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([single, pairs])
        is_single = np.concatenate([np.ones(len(single), dtype=bool), np.zeros(len(pairs), dtype=bool)])
        by_weight = np.argsort(both, kind="stable")
        rounds.append(is_single[by_weight])
        merged = both[by_weight]
    lengths = np.zeros(len(ids), dtype=np.int64)
    taken = 2 * len(ids) - 2
    for is_single in reversed(rounds):
        singles = int(is_single[:taken].sum())
        lengths[:singles] += 1
        taken = 2 * (taken - singles)
    lengths[:taken] += 1
    return {int(i): int(n) for i, n in zip(ids[order], lengths)}


class Code:
    """Canonical code: ids in order of (length, id) get consecutive codes."""

    def __init__(self, lengths: dict[int, int]):
        size = max(lengths, default=0) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        self.codes = np.zeros(size, dtype=np.uint32)
        ids = np.zeros(1 << LONGEST, dtype=np.uint32)
        steps = np.ones(1 << LONGEST, dtype=np.int64)
        code, before = 0, 0
        for length, i in sorted((n, i) for i, n in lengths.items()):
            code <<= length - before
            before = length
            self.lengths[i], self.codes[i] = length, code
            low = code << (LONGEST - length)
            ids[low : low + (1 << (LONGEST - length))] = i
            steps[low : low + (1 << (LONGEST - length))] = length
            code += 1
        self.table_ids, self.table_steps = ids, steps

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of the ids, padded by a byte group, and the bit offset of every checkpoint."""
        lengths = self.lengths[ids]
        if not lengths.all():
            raise ValueError("an id has no code")
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        starts = ends - lengths
        words = np.zeros(total // 32 + 3, dtype=np.uint64)
        # A code spans two 32-bit words at most; codes do not overlap, so sums are unions.
        shifted = self.codes[ids].astype(np.uint64) << (64 - (starts & 31) - lengths).astype(np.uint64)
        at = starts >> 5
        if len(ids):
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            words[at[first]] += np.add.reduceat(shifted >> np.uint64(32), first)
            words[at[first] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes(), starts[::CHECKPOINT].astype("<u4")

    def decode(self, bits: bytes, offsets: np.ndarray, count: int) -> np.ndarray:
        """The ids; every stretch between checkpoints moves on by one id at a time, all together."""
        words = np.frombuffer(bits, dtype=">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        place = offsets.astype(np.int64)
        out = np.zeros((CHECKPOINT, len(place)), dtype=np.uint32)
        tail = count - CHECKPOINT * (len(place) - 1)
        for step in range(CHECKPOINT if len(place) > 1 else tail):
            if step == tail:
                place = place[:-1]
            window = (pairs[place >> 5] >> (48 - (place & 31)).astype(np.uint64)) & np.uint64(0xFFFF)
            out[step, : len(place)] = self.table_ids[window]
            place = place + self.table_steps[window]
        return out.T.reshape(-1)[:count]


# -- jobs ----------------------------------------------------------------------------------------


def in_ranges(docs: DataFrame, rows_per_range: int = 4096) -> DataFrame:
    """``part, doc_id, text`` dealt to ranges of doc_id, sorted inside.

    Bounds are quantiles of doc_id alone; where many rows share one id its range is just larger, and
    blocks keep memory bounded there.
    """
    count, low = docs.agg(F.count("*"), F.min("doc_id")).first()
    ranges = max(1, -(-count // rows_per_range))
    cuts: list = []
    if low is not None and ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0]))
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda c: c < F.col("doc_id"))))
    dealt = docs.select(part.cast("int").alias("part"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return dealt.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")


def _tokenize(path: str, end: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        block = 0
        for batch in batches:
            texts = batch.column(2).to_pylist()
            parts = batch.column(0).to_pylist()
            ids = batch.column(1).to_pylist()
            for low, high in groups_of(texts):
                encoded = encode_many(tokenizer, texts[low:high])
                held: list[int] = []
                size = 0
                for k in range(high - low + 1):
                    length = len(encoded[k]) + 1 if k < high - low else 0
                    if held and (k == high - low or size + length > BLOCK_IDS):
                        flat = np.concatenate([np.append(encoded[h], np.uint32(end)) for h in held]).astype("<u4")
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([parts[low + held[0]]], pa.int32()),
                                pa.array([block], pa.int64()),
                                pa.array([[ids[low + h] for h in held]], pa.list_(pa.int64())),
                                pa.array([[len(encoded[h]) + 1 for h in held]], pa.list_(pa.int64())),
                                pa.array([flat.astype("<u2").tobytes() if flat.max() < 1 << 16 else flat.tobytes()], pa.binary()),
                            ],
                            ["part", "block", "doc_ids", "lengths", "ids"],
                        )
                        block += 1
                        held, size = [], 0
                    held.append(k)
                    size += length

    return blocks


def _plain_ids(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * count else "<u4").astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for lengths, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.bincount(_plain_ids(raw, sum(lengths)), minlength=len(total))
            counts[: len(total)] += total
            total = counts
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def _encode(lengths: dict[int, int]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                bits, offsets = code.encode(_plain_ids(row.column(4)[0].as_py(), sum(row.column(3)[0].as_py())))
                columns = [row.column(k) for k in range(4)] + [pa.array([bits], pa.binary()), pa.array([offsets.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "doc_ids", "lengths", "bits", "checkpoints"])

    return encode


def write_token_files(docs: DataFrame, vocabulary: str, path: str, end: int = END) -> str:
    """Encode every document, append ``end``, and write code and blocks below ``path``."""
    spark = docs.sparkSession
    schema = "part int, block long, doc_ids array<bigint>, lengths array<bigint>, "
    plain = staged(in_ranges(docs).mapInArrow(_tokenize(vocabulary, end), schema + "ids binary"), stage_path(spark, "ids"))
    counts = plain.select("lengths", "ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    lengths = code_lengths({r["id"]: r["n"] for r in counts.collect()})  # no longer than the vocabulary
    rows = [(int(i), int(n)) for i, n in lengths.items()]
    stage_write(spark.createDataFrame(rows, "id long, length long").coalesce(1), f"{path}/code")
    stage_write(plain.mapInArrow(_encode(lengths), schema + "bits binary, checkpoints binary"), f"{path}/blocks")
    return path


def _decode(lengths: dict[int, int]):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                sizes = row["lengths"]
                ids = code.decode(row["bits"], np.frombuffer(row["checkpoints"], dtype="<u4"), sum(sizes)).astype("<u4")
                ends = np.cumsum(sizes)
                starts = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(sizes), pa.int32()),
                        pa.array([row["block"]] * len(sizes), pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([ids[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                    ],
                    ["part", "block", "doc_id", "inside", "n_tokens", "ids"],
                )

    return decode


def read_token_files(spark, path: str) -> DataFrame:
    """``part, block, doc_id, inside, n_tokens, ids``: documents with their little-endian 32-bit ids."""
    lengths = {r["id"]: r["length"] for r in stage_read(spark, f"{path}/code").collect()}
    schema = "part int, block long, doc_id long, inside long, n_tokens long, ids binary"
    return stage_read(spark, f"{path}/blocks").mapInArrow(_decode(lengths), schema)


def block_starts(spark, path: str) -> DataFrame:
    """``part, block, start``: ids of all blocks before. Totals of ranges first, then blocks inside."""
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
    blocks = stage_read(spark, f"{path}/blocks").select("part", "block", size.alias("n"))
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.join(parts, "part").select(
        "part", "block", (F.col("part_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start")
    )


def token_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the files, read them back and give each document's place, length and checksum."""
    spark = docs.sparkSession
    path = write_token_files(docs, vocabulary, stage_path(spark, "tokens"))
    read = read_token_files(spark, path).select("part", "block", "doc_id", "inside", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(block_starts(spark, path), ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
