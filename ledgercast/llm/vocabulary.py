"""A public tokenizer applied word by word.

The tokenizer lower-cases a text, drops white space, cuts the rest into pieces that never span white
space and encodes each on its own. So the ids of a text are the ids of its words in a row, and each
distinct word is encoded once and looked up after that. Texts with anything but plain Latin letters,
ASCII and common white space, or with what could be a special token, go through the library whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_WORDS = 1_000_000
TOGETHER = 2000
# The pattern of the vocabulary file that cuts lower-cased plain words into pieces.
PIECE = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
NOT_PLAIN = re.compile(r"[^\x20-\x7e\t\n\r\xc0-\xff]")


class WordTokenizer:
    """Ids by word, with a cache of bounded size. Number 0 is the empty word without ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.starts = np.empty(1 << 14, dtype=np.int64)
        self.counts = np.empty(1 << 14, dtype=np.int64)
        self.met = np.zeros(1 << 14, dtype=np.int32)
        self.starts[0] = self.counts[0] = 0
        self.used = 0

    def _shrink(self) -> None:
        """Keep the words met in more than one group of texts, or none if they are too many still."""
        kept = [(word, n) for word, n in self.index.items() if n and self.met[n] > 1]
        numbers = np.array([n for _, n in kept], dtype=np.int64)
        ids, counts, met = self.ids(numbers), self.counts[numbers], self.met[numbers]
        self.forget()
        if len(kept) <= MOST_WORDS // 2:
            self._store([word for word, _ in kept], ids, counts)
            self.met[1 : len(kept) + 1] = met // 2

    def _store(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        at, used = len(self.index), self.used
        while used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        while at + len(words) > len(self.starts):
            self.starts, self.counts = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.counts, 2 * len(self.counts))
            self.met = np.append(self.met, np.zeros(len(self.met), dtype=np.int32))
        self.flat[used : used + len(ids)] = ids
        self.counts[at : at + len(words)] = counts
        self.starts[at : at + len(words)] = used + np.cumsum(counts) - counts
        self.used += len(ids)
        self.index.update(zip(words, range(at, at + len(words))))

    def _learn(self, words: list[str]) -> None:
        """Encode unknown words: first their unknown pieces, many in one text (the library says which
        piece each id belongs to), then words of several pieces from those."""
        cut = [(word, PIECE.findall(word)) for word in words if not word.isalpha()]
        parts = chain(filter(str.isalpha, words), chain.from_iterable(own for _, own in cut))
        pieces = [p for p in dict.fromkeys(parts) if p not in self.index]
        for start in range(0, len(pieces), TOGETHER):
            some = pieces[start : start + TOGETHER]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            counts = np.bincount(encoded.word_ids, minlength=len(some))
            if len(counts) != len(some):
                raise ValueError("the vocabulary file cuts words in another way")
            self._store(some, np.array(encoded.ids, dtype=np.uint32), counts)
        several = [(word, own) for word, own in cut if len(own) > 1]
        if several:
            numbers = np.array([self.index[p] for _, own in several for p in own], dtype=np.int64)
            firsts = np.cumsum([0] + [len(own) for _, own in several[:-1]])
            counts = np.add.reduceat(self.counts[numbers], firsts)
            self._store([word for word, _ in several], self.ids(numbers), counts)

    def plain(self, text: str) -> bool:
        return NOT_PLAIN.search(text) is None and "<|" not in text

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of plain texts: the cache numbers of all words, and how many words each text has."""
        if len(self.index) > MOST_WORDS:
            self._shrink()
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        unknown = [w for w in words if w not in self.index]
        if unknown:
            self._learn(unknown)
        distinct = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        self.met[distinct] += 1
        numbers = distinct[coded.indices.to_numpy()]
        empty = np.flatnonzero(numbers == 0)  # white space at either end of a text
        if len(empty):
            sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[empty], minlength=len(sizes))
            numbers = np.delete(numbers, empty)
        return numbers, sizes

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of words in a row."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        offsets = np.arange(total) - np.repeat(ends - counts, counts)
        return self.flat[np.repeat(self.starts[numbers], counts) + offsets]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker process."""
    return WordTokenizer(path)


def groups_of(texts: list[str], most: int = 2_000_000):
    """Ranges of texts of about ``most`` characters together; a longer text is alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def encode_many(tokenizer: WordTokenizer, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text."""
    out: list[np.ndarray | None] = [None] * len(texts)
    plain = [i for i, t in enumerate(texts) if tokenizer.plain(t)]
    numbers, sizes = tokenizer.numbers([texts[i] for i in plain])
    ids = tokenizer.ids(numbers)
    ends = np.r_[0, np.cumsum(tokenizer.counts[numbers])]
    bounds = np.r_[0, np.cumsum(sizes)]
    for k, i in enumerate(plain):
        out[i] = ids[ends[bounds[k]] : ends[bounds[k + 1]]]
    for i, ids in enumerate(out):
        if ids is None:
            out[i] = np.array(tokenizer.whole(texts[i]), dtype=np.uint32)
    return out
