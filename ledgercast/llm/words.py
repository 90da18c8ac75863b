"""Words of a text, as every operator here sees them: maximal runs without ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_count(text: Column) -> Column:
    """UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def byte_words(text: str | None, lower: bool = True) -> list[bytes]:
    """The words as UTF-8 bytes. ``bytes`` methods know ASCII only, which is what is asked for."""
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()
