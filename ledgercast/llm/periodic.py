"""Periodic runs of words, found by recursive frequency splitting.

A run repeats a stretch of q words four times or more, so each of its words occurs at least four times within
it. A word that occurs less often in its segment is in no run and splits the segment; the parts are
counted anew until nothing splits. The segments that are left are scanned for lags by doubling: at width w
(1, 2, 4, …) every position knows its distance to the next equal stretch of w words. In a run of period q,
w / 2 < q <= w, that distance is q at every place where a stretch and its repetition fit, and nowhere beside the
run, so constant distances are the runs, maximal and with their smallest period. A long text costs
n log² n, its words never meet another text's, and no row leaves its task.

Null and blank texts have no words and no runs; their collapsed text is empty. Rows are kept as they are,
whatever their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from ledgercast.llm.words import byte_words

TIMES = 4
LEAST = 6
WORDS_AT_ONCE = 1 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


def frequent_segments(ids: np.ndarray) -> np.ndarray:
    """Whether each position is in a segment all of whose words occur ``TIMES`` times or more in it."""
    alive = np.bincount(ids)[ids] >= TIMES if len(ids) else np.zeros(0, dtype=bool)
    asked = np.flatnonzero(alive)
    while len(asked):
        # Segments are stretches of neighbouring positions; only those that lost one are asked again.
        segment = np.cumsum(np.r_[True, np.diff(asked) > 1])
        lengths = np.bincount(segment)[segment]
        order = np.lexsort((ids[asked], segment))
        new = np.r_[True, (np.diff(segment[order]) != 0) | (np.diff(ids[asked][order]) != 0)]
        counts = np.diff(np.r_[np.flatnonzero(new), len(order)])
        often = np.empty(len(order), dtype=np.int64)
        often[order] = np.repeat(counts, counts)
        stays = (often >= TIMES) & (lengths >= LEAST)
        alive[asked[~stays]] = False
        hurt = np.zeros(int(segment[-1]) + 1, dtype=bool)
        hurt[segment[~stays]] = True
        asked = asked[stays & hurt[segment]]
    return alive


def _next_equal(ranks: np.ndarray) -> np.ndarray:
    """Distance from each position to the next of the same rank; 0 for the last."""
    order = np.argsort(ranks, kind="stable")
    away = np.zeros(len(ranks), dtype=np.int64)
    same = ranks[order[1:]] == ranks[order[:-1]]
    away[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return away


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of every maximal stretch of one value."""
    change = np.flatnonzero(np.diff(values)) + 1
    return np.r_[0, change], np.r_[change, len(values)] - 1


def periodic_runs(ids: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    alive = frequent_segments(ids)
    found = [np.empty((0, 3), dtype=np.int64)]
    width = 1
    position = np.flatnonzero(alive)
    if len(position):
        # One place between segments holds a number of its own, so nothing matches across it.
        breaks = np.flatnonzero(np.diff(position) > 1) + 1
        ranks = np.insert(ids[position], breaks, int(ids.max()) + 1 + np.arange(len(breaks)))
        position = np.insert(position, breaks, -1)
        total = len(ranks)
        while True:
            away = _next_equal(ranks)
            away[(2 * away <= width) | (away > width)] = 0
            first, last = _stretches(away)
            period = away[first]
            length = last - first + width + period
            runs = (period > 0) & (length >= np.maximum(LEAST, TIMES * period))
            found.append(np.stack([position[first[runs]], length[runs], period[runs]], axis=1))
            if TIMES * (width + 1) > total:
                break
            pairs = ranks[:-width] * (int(ranks.max()) + 1) + ranks[width:]
            _, ranks = np.unique(pairs, return_inverse=True)
            position = position[: len(ranks)]
            width *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeated_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``count`` words is in a run after the run's first period."""
    depth = np.zeros(count + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:count] > 0


def _texts(texts: list[list[bytes]]) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each text. All are scanned as one sequence; no word of one is a word of another."""
    ids = np.empty(sum(map(len, texts)), dtype=np.int64)
    start = known = 0
    for words in texts:
        number: dict[bytes, int] = {}
        ids[start : start + len(words)] = [number.setdefault(w, known + len(number)) for w in words]
        known, start = known + len(number), start + len(words)
    runs = periodic_runs(ids)
    dropped = repeated_words(len(ids), runs)
    bounds = np.cumsum([0, *map(len, texts)])
    first = np.searchsorted(runs[:, 0], bounds)
    for k, words in enumerate(texts):
        own = runs[first[k] : first[k + 1]]
        if not len(own):
            yield [], b" ".join(words).decode()
            continue
        kept = np.flatnonzero(~dropped[bounds[k] : bounds[k + 1]])
        listed = [{"start": s, "length": n, "period": q} for s, n, q in (own - [bounds[k], 0, 0]).tolist()]
        yield listed, b" ".join([words[i] for i in kept.tolist()]).decode()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    for batch in batches:
        first = 0
        while first < batch.num_rows:
            texts, size, last = [], 0, first
            while last < batch.num_rows and size < WORDS_AT_ONCE:
                texts.append(byte_words(batch.column(1)[last].as_py(), lower=False))
                size += len(texts[-1])
                last += 1
            runs, collapsed = zip(*_texts(texts))
            counts = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0).slice(first, last - first), counts, pa.array(runs, kind), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])
            first = last


def run_ledger(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``: the runs (start, length, period) in words, by
    start, then period, and the text without the words that runs repeat, joined by one space."""
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    )
    return docs.select("doc_id", "text").mapInArrow(_scan, schema)
