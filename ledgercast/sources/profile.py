"""Profile source: one wide row per client and month; the end of a column name tells its role."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledgercast.sources.ledger import open_table, with_dates

KEYS = ["epk_id", "report_dt"]


@dataclass(frozen=True)
class SuffixGroups:
    """The last token of a column name, by role."""

    categorical: tuple[str, ...] = ("cd", "group", "nflag", "segm", "subsegm")
    numeric: tuple[str, ...] = ("amt", "days", "nv", "pct", "qty", "rate")
    date: tuple[str, ...] = ("dt",)

    @classmethod
    def from_json(cls, path: str) -> SuffixGroups:
        """Read ``{role: [suffixes]}``."""
        saved = json.loads(Path(path).read_text(encoding="utf-8"))
        return cls(**{role: tuple(suffixes) for role, suffixes in saved.items()})

    def role(self, column: str) -> str | None:
        suffix = column.rsplit("_", 1)[-1]
        for role in ("categorical", "numeric", "date"):
            if suffix in getattr(self, role):
                return role
        return None

    def features(self, columns: list[str]) -> list[str]:
        return [c for c in columns if c not in KEYS and self.role(c)]


def select_by_suffix(profile: DataFrame, groups: SuffixGroups = SuffixGroups()) -> DataFrame:
    """Keys and every column with a known suffix."""
    return profile.select(*KEYS, *groups.features(profile.columns))


def select_feature_sample(
    profile: DataFrame, wanted: list[str], groups: SuffixGroups = SuffixGroups()
) -> DataFrame:
    """Keys and the wanted columns that have a known suffix."""
    return profile.select(*KEYS, *groups.features(wanted))


def scan_profile(
    spark: SparkSession,
    source: str | DataFrame,
    wanted: list[str] | None = None,
    groups: SuffixGroups = SuffixGroups(),
    months: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    profile = with_dates(open_table(spark, source), months=months)
    return select_by_suffix(profile, groups) if wanted is None else select_feature_sample(profile, wanted, groups)
