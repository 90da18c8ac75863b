"""Exact token counts at every prefix.

The count of a prefix that ends with a word is the count of the one before plus the word's own: a
running sum over the text, stored as (end, count) pairs. From the stored table any question about
budgets is answered without encoding the text again: how many tokens, where to cut for a budget, how
many tokens up to a position. Only a position inside a word needs that one word.

Null texts are empty and have no tokens. Ends are in characters of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgercast.llm.vocabulary import WordTokenizer, groups_of, word_tokenizer

STEP = np.dtype([("end", "<u4"), ("count", "<u4")])
LIMIT = 2048


def word_ends(text: str) -> np.ndarray:
    """Position after each word of a plain text."""
    white = np.frombuffer((text + " ").encode("utf-32-le"), dtype="<u4") <= 32
    return np.flatnonzero(white[1:] & ~white[:-1]) + 1


def prefix_steps(tokenizer: WordTokenizer, texts: list[str]) -> list[np.ndarray]:
    """(end, count) of each text after each of its words."""
    out: list[np.ndarray | None] = [None] * len(texts)
    plain = [i for i, t in enumerate(texts) if tokenizer.plain(t)]
    numbers, sizes = tokenizer.numbers([texts[i] for i in plain])
    running = np.cumsum(tokenizer.counts[numbers])
    bounds = np.r_[0, np.cumsum(sizes)]
    for k, i in enumerate(plain):
        low, high = bounds[k], bounds[k + 1]
        steps = np.empty(high - low, dtype=STEP)
        steps["count"] = running[low:high] - (running[low - 1] if low else 0)
        steps["end"] = word_ends(texts[i])
        out[i] = steps
    for i, steps in enumerate(out):
        if steps is None:
            out[i] = steps_of_any(tokenizer, texts[i])
    return out


def steps_of_any(tokenizer: WordTokenizer, text: str) -> np.ndarray:
    """The same from the library's own offsets: a step wherever the next token starts further on."""
    encoded = tokenizer.tokenizer.encode(text, add_special_tokens=False)
    ends = [end for _, end in encoded.offsets]
    starts = [start for start, _ in encoded.offsets[1:]] + [len(text)]
    last = [i for i, (end, start) in enumerate(zip(ends, starts)) if start >= end]
    steps = np.empty(len(last), dtype=STEP)
    steps["end"], steps["count"] = [ends[i] for i in last], [i + 1 for i in last]
    if len(ends) and (not len(steps) or steps["count"][-1] != len(ends)):
        steps = np.append(steps, np.array([(len(text), len(ends))], dtype=STEP))
    return steps


def read_steps(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, dtype=STEP)


def tokens_in(steps: np.ndarray) -> int:
    return int(steps["count"][-1]) if len(steps) else 0


def cut_for_budget(steps: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix that ends with a word and has at most ``budget`` tokens."""
    fitting = int(np.searchsorted(steps["count"], budget, side="right"))
    return int(steps["end"][fitting - 1]) if fitting else 0


def tokens_up_to(steps: np.ndarray, text: str, position: int, tokenizer: WordTokenizer) -> int:
    """Tokens of the first ``position`` characters; at most one word is encoded."""
    whole = int(np.searchsorted(steps["end"], position, side="right"))
    before = int(steps["count"][whole - 1]) if whole else 0
    start = int(steps["end"][whole - 1]) if whole else 0
    return before + len(tokenizer.whole(text[start:position]))


def _table(path: str):
    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, high in groups_of(texts):
                steps = prefix_steps(tokenizer, texts[low:high])
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2),
                        pa.array([tokens_in(s) for s in steps], pa.int64()),
                        pa.array([s.tobytes() for s in steps], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "steps"],
                )

    return table


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, steps``, one row per row of ``docs``, map-side throughout."""
    given = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(_table(path), f"doc_id {kind}, n_bytes long, n_tokens long, steps binary")


def over_limit(table: DataFrame, limit: int = LIMIT) -> DataFrame:
    return table.withColumn("over_limit", F.col("n_tokens") > limit)
