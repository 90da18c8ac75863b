"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; a policy is a named, versioned set of bits, so a new policy or an ablation needs the ledger
only, never the texts.

Null texts count as empty. Documents are judged row by row, so repeated rows get the same verdict.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgercast.llm.words import byte_words

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouts"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more. ``window`` is a power of two.

    Windows are numbered by doubling: two windows of k words get the same number exactly when they
    are equal, so nothing rests on hashes.
    """
    if len(words) <= window:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    kinds, width = len(index), 1
    while width < window:
        if kinds == len(ids):
            return 0
        _, ids = np.unique(ids[:-width] * (kinds + 1) + ids[width:], return_inverse=True)
        kinds, width = int(ids.max()) + 1, 2 * width
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode()
    words = byte_words(text, lower=False)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in WHITE),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        raw.count(b"!!"),
    )


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=MEASURES)


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` holds on the measurements."""

    name: str
    fails: str
    bit: int

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule("few_words", "n_words < 20", 0),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words", 1),
    Rule("symbols", "10 * n_symbols > n_words", 2),
    Rule("repeated_lines", "10 * n_dup_lines > 4 * n_lines", 3),
    Rule("short_words", "word_chars < 2 * n_words", 4),
    Rule("long_words", "word_chars > 20 * n_words", 5),
    Rule("shouting", "10 * n_shouts > 3 * n_words", 6),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A document is kept if it fails none of the policy's rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        known = {r.name: r.mask for r in rules}
        return sum(known[name] for name in set(self.rules))

    def keeps(self, failures: Column, rules: tuple[Rule, ...] = RULES) -> Column:
        return failures.bitwiseAND(F.lit(self.mask(rules))) == 0


BASE_POLICY = Policy("base", 1, BASE)
PRODUCTION = Policy("production", 1, tuple(r.name for r in RULES))


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    """One bit per failed rule, from the measurement columns."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(rule.mask)).otherwise(F.lit(0)).cast("long"))
    return bits


def quality_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the measurements and ``failures``; one row per row of ``docs``."""
    measured = docs.select("doc_id", measures("text").alias("m")).select("doc_id", "m.*")
    return measured.withColumn("failures", failure_bits(rules))


def apply_policy(ledger: DataFrame, policy: Policy = PRODUCTION, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``kept``."""
    return ledger.withColumn("kept", policy.keeps(F.col("failures"), rules))


def ablations(ledger: DataFrame, policy: Policy = PRODUCTION, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rule, failed, alone``: documents each rule rejects, and those that only it rejects.

    Documents are first counted per combination of bits, so the rest works on at most
    2^rules rows. An empty ledger gives zeros.
    """
    combinations = ledger.groupBy("failures").agg(F.count("*").alias("n"))
    mask = policy.mask(rules)
    sums = []
    for rule in (r for r in rules if r.name in policy.rules):
        hit = F.col("failures").bitwiseAND(F.lit(rule.mask)) != 0
        only = F.col("failures").bitwiseAND(F.lit(mask)) == rule.mask
        for name, where in (("failed", hit), ("alone", only)):
            sums.append(F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).alias(f"{rule.name}_{name}"))
    names = [r.name for r in rules if r.name in policy.rules]
    pairs = ", ".join(f"'{n}', {n}_failed, {n}_alone" for n in names)
    return combinations.agg(*sums).selectExpr(f"stack({len(names)}, {pairs}) AS (rule, failed, alone)")


def keep_good(docs: DataFrame, policy: Policy = PRODUCTION, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of ``docs`` that the policy keeps, in their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = docs.select(row.alias("row"), measures("text").alias("m")).select("row", "m.*")
    return judged.where(policy.keeps(failure_bits(rules), rules)).select("row.*")
