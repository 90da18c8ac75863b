"""Language-model scores from log-frequency Bloom filters.

The model is a bigram model over words and an end mark, smoothed with the add-one unigram model:

    p(w | u) = g(u) x q(u w) / c(u) + (1 - g(u)) x p1(w),   g(u) = c(u) / (c(u) + 4)

q is the bigram's count in training, rounded down to a power of two. A filter holds, for a bigram of
level j, the items (bigram, 1) ... (bigram, j); its level is found by probing 1, 2, ... until a probe
fails. As q(u w) never adds up to more than c(u), neither do the probabilities of all words to more
than 1. The first word follows the end mark.

A filter for the whole corpus grows with it, so it isn't sent to all workers: it is cut by hash into
segments, each built and probed in one place. Documents are put into chunks of about 4 MB. A chunk
sends the sorted hashes of its distinct words and bigrams, with their training counts, to the
segments; every segment adds up, builds its filter, and returns a level (words: an exact count) for
each hash in the order it came. The answers meet the chunk again, which scores its documents. A word
in every document is one entry per chunk.

A chunk's memory is that of its text and its distinct hashes: texts are hashed in pieces of about
512 KB, and tables with whole texts pass to Python in batches of about a chunk.

Null texts are empty: an end mark only. Words and bigrams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.llm.rolling import LOWER, WHITE, mixed, running, stretches
from ledgercast.session import arrow_batches, stage_path
from ledgercast.sources.stages import stage_read, staged

CHUNK_BYTES = 4 << 20
PIECE_BYTES = 512 << 10
SEGMENT_BYTES = 12 << 20
BITS_PER_ITEM = 12
PROBES = 6
PRIOR = 4.0
FOLDS, HELD_FOLD = 7, 2
END = np.uint64(0x9AE16A3B2F90404F)


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_FOLD


# -- filter --------------------------------------------------------------------------------------


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + log2 of the count, rounded down; 0 for 0."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


class LogFrequencyFilter:
    """Bloom filter of (item, level) pairs."""

    def __init__(self, items: np.ndarray, levels: np.ndarray):
        total = int(levels.sum())
        self.size = max(64, BITS_PER_ITEM * total)
        self.bits = np.zeros(self.size // 8 + 1, dtype=np.uint8)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for place in self._places(items[levels >= level], level):
                np.bitwise_or.at(self.bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def _places(self, items: np.ndarray, level: int) -> Iterator[np.ndarray]:
        first = mixed(items + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
        step = mixed(first) | np.uint64(1)
        for probe in range(PROBES):
            yield (first + np.uint64(probe) * step) % np.uint64(self.size)

    def levels(self, items: np.ndarray) -> np.ndarray:
        """Level of each item: the last of 1, 2, ... whose probes all succeed."""
        out = np.zeros(len(items), dtype=np.int64)
        live = np.arange(len(items))
        level = 1
        while len(live):
            there = np.ones(len(live), dtype=bool)
            for place in self._places(items[live], level):
                there &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            live = live[there]
            out[live] = level
            level += 1
        return out


# -- chunks --------------------------------------------------------------------------------------


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of texts in a row, each text closed by the end mark; tokens per text.

    A hash does not depend on where its word stands, so pieces of the texts give the same hashes.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.flatnonzero(np.diff((ends - 1) // PIECE_BYTES)) + 1
    pieces = [_piece_hashes(texts[low:high]) for low, high in zip([0, *cuts], [*cuts, len(texts)])]
    return tuple(np.concatenate(parts) for parts in zip(*pieces))


def _piece_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    white = WHITE[data]
    starts = np.flatnonzero(~white & np.r_[True, white[:-1]])
    ends = np.flatnonzero(white & np.r_[False, ~white[:-1]])
    words = stretches(running(data), starts, ends)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    closing = np.searchsorted(starts, bounds)
    tokens = np.insert(words, closing, END)
    return tokens, np.diff(np.r_[0, closing]) + 1


def bigram_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; the first follows an end mark."""
    before = np.r_[END, tokens[:-1]]
    return mixed(before * np.uint64(0x9FB21C651E98DF25) + tokens)


def pack(values: np.ndarray) -> bytes:
    """Byte planes: equal high bytes stand together and compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unpack(stored: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(stored, dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def segment_bounds(sorted_hashes: np.ndarray, segments: int) -> np.ndarray:
    """Where each segment begins among sorted hashes: segments are equal ranges of hashes."""
    step = (1 << 64) // segments
    cuts = np.array([k * step for k in range(1, segments)], dtype=np.uint64)
    return np.r_[0, np.searchsorted(sorted_hashes, cuts), len(sorted_hashes)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = number = 0

    def close() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        one = [pa.ListArray.from_arrays([0, table.num_rows], table.column(c).combine_chunks()) for c in range(3)]
        place = pa.array([f"{held_part[0]}-{number}"])
        return pa.RecordBatch.from_arrays([place, *one], ["chunk", "doc_ids", "held", "texts"])

    held_part = [0]
    for batch in batches:
        if batch.num_rows:
            held_part[0] = batch.column(3)[0].as_py()
        start = 0
        for i, n in enumerate(pc.binary_length(batch.column(2)).to_pylist()):
            if size and size + n > CHUNK_BYTES:
                held.append(batch.slice(start, i - start).select([0, 1, 2]))
                yield close()
                held, start, size, number = [], i, 0, number + 1
            size += n + 1
        held.append(batch.slice(start).select([0, 1, 2]))
    if size:
        yield close()


def chunked(docs: DataFrame) -> DataFrame:
    """``chunk, doc_ids, held, texts``: written, so that both passes see the same chunks."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.spark_partition_id().alias("part"),
    )
    chunks = rows.mapInArrow(_chunks, f"chunk string, doc_ids array<{kind}>, held array<boolean>, texts array<binary>")
    path = stage_path(docs.sparkSession, "chunks")
    with arrow_batches(docs.sparkSession, CHUNK_BYTES):
        chunks.write.option("compression", "zstd").parquet(path)
    return stage_read(docs.sparkSession, path)


def _send(segments: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, held, texts = (batch.column(c)[i].as_py() for c in range(3))
                tokens, sizes = token_hashes(texts)
                train = np.repeat(~np.array(held), sizes)
                for kind, hashes in enumerate((tokens, bigram_hashes(tokens))):
                    distinct, inverse = np.unique(hashes, return_inverse=True)
                    counts = np.bincount(inverse, weights=train, minlength=len(distinct)).astype(np.uint32)
                    bounds = segment_bounds(distinct, segments)
                    asked = np.flatnonzero(np.diff(bounds))
                    ranges = list(zip(bounds[asked].tolist(), bounds[asked + 1].tolist()))
                    steps = [pack(np.diff(distinct[low:high], prepend=np.uint64(0))) for low, high in ranges]
                    columns = [
                        pa.array(kind * segments + asked, pa.int32()), pa.array([chunk] * len(asked), pa.string()),
                        pa.array(steps, pa.binary()), pa.array([pack(counts[low:high]) for low, high in ranges], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["segment", "chunk", "steps", "counts"])

    return send


def _answer(segments: int):
    def answer(rows: pa.Table) -> pa.Table:
        segment = rows.column(0)[0].as_py()
        asked = [np.cumsum(unpack(s, "<u8"), dtype=np.uint64) for s in rows.column(2).to_pylist()]
        ends = np.cumsum([len(a) for a in asked])
        starts, count = ends - [len(a) for a in asked], len(asked)
        every = np.concatenate(asked)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        del asked, every
        fresh = np.r_[True, ordered[1:] != ordered[:-1]]
        items = ordered[fresh]
        counts = np.concatenate([unpack(c, "<u4") for c in rows.column(3).to_pylist()]).astype(np.int64)
        sums = np.add.reduceat(counts[order], np.flatnonzero(fresh))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(fresh) - 1
        del ordered, order, counts, fresh
        if segment < segments:
            found = sums.astype("<u8")
            total, kinds = int(sums.sum()), int((sums > 0).sum())
        else:
            seen = sums > 0
            lookup = LogFrequencyFilter(items[seen], levels_of(sums[seen]))
            found = lookup.levels(items).astype("<u8")
            total = kinds = 0
        return pa.table(
            {
                "chunk": rows.column(1), "segment": pa.array([segment] * count, pa.int32()),
                "answers": pa.array([pack(found[place[low:high]]) for low, high in zip(starts, ends)], pa.binary()),
                "total": pa.array([total] + [0] * (count - 1), pa.int64()),
                "kinds": pa.array([kinds] + [0] * (count - 1), pa.int64()),
            }
        )

    return answer


def _score(total: int, kinds: int):
    floor = float(total + kinds + 1)

    def score(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        doc_ids, held, texts = (chunks.column(i)[0].as_py() for i in (1, 2, 3))
        tokens, sizes = token_hashes(texts)
        in_order = np.argsort(np.array(answers.column(1).to_pylist()))
        parts = [unpack(answers.column(2)[int(i)].as_py(), "<u8") for i in in_order]
        flat = np.concatenate(parts).astype(np.int64)
        words, word_of = np.unique(tokens, return_inverse=True)
        pairs, pair_of = np.unique(bigram_hashes(tokens), return_inverse=True)
        count = flat[: len(words)][word_of]
        level = flat[len(words) :][pair_of]
        end_count = flat[: len(words)][np.searchsorted(words, END)]
        before = np.r_[end_count, count[:-1]].astype(np.float64)
        base = (count + 1) / floor
        rounded = np.where(level > 0, 2.0 ** (level - 1), 0.0)
        trust = before / (before + PRIOR)
        seen = np.minimum(1.0, rounded / np.maximum(before, 1.0))
        model = np.where(before > 0, trust * seen, 0.0) + (1.0 - trust) * base
        firsts = np.cumsum(sizes) - sizes
        return pa.table(
            {
                "doc_id": pa.array(doc_ids, chunks.schema.field(1).type.value_type),
                "held_out": pa.array(held, pa.bool_()),
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), firsts), pa.int64()),
                "train_tokens": pa.array([total] * len(sizes), pa.int64()),
                "base_score": pa.array(np.add.reduceat(np.log10(base), firsts)),
                "score": pa.array(np.add.reduceat(np.log10(model), firsts)),
            }
        )

    return score


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, a row per row."""
    spark = docs.sparkSession
    chunks = chunked(docs)
    amount = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(4, -(-amount // SEGMENT_BYTES))
    sent = chunks.select("chunk", "held", "texts").mapInArrow(
        _send(segments), "segment int, chunk string, steps binary, counts binary"
    )
    groups = sent.groupBy("segment").applyInArrow(_answer(segments), "chunk string, segment int, answers binary, total long, kinds long")
    with arrow_batches(spark, CHUNK_BYTES):
        answers = staged(groups, stage_path(spark, "answers"))
    total, kinds = answers.agg(F.sum("total"), F.sum("kinds")).first()
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    replies = answers.select("chunk", "segment", "answers")
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_score(total or 0, kinds or 0), schema)
