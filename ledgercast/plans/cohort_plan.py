"""Which clients are looked at in which report month.

A cell pairs a block of hash buckets with a range of report months. The plan is a handful of
settings, so it lives in plain Python; :meth:`CohortPlan.buckets_frame` turns it into the lookup
table that joins to data on the bucket number.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ledgercast.functions.calendar import month_end, month_range
from ledgercast.sources.local_table import local_table

LEDGER_WINDOW = "ledger"
PROFILE_WINDOW = "profile"


@dataclass(frozen=True)
class Cell:
    split: str
    bin_lo: int
    bin_hi: int
    report_from: dt.date
    report_to: dt.date

    def months(self) -> list[dt.date]:
        return month_range(self.report_from, self.report_to)


@dataclass(frozen=True)
class CohortSettings:
    """Training plan: each train month, and each test month, owns a block of buckets."""

    history_months: int = 6
    predict_months: int = 12
    buckets: int = 300
    train_from: str = "2020-06-30"
    train_months: int = 1
    train_bucket: int = 1
    train_width: int = 10
    test_from: str = "2020-09-30"
    test_months: int = 1
    test_bucket: int = 20
    test_width: int = 1
    hash_kind: str = "murmur3"


@dataclass(frozen=True)
class ScoringSettings:
    """Scoring plan: the same blocks, without months to predict."""

    history_months: int = 6
    buckets: int = 1
    report_from: str = "2020-09-30"
    report_months: int = 1
    first_bucket: int = 0
    width: int = 1
    hash_kind: str = "murmur3"


def _blocks(split: str, first: str, months: int, bucket: int, width: int) -> list[Cell]:
    cells = []
    for i in range(months):
        month = month_end(first, i)
        lo = bucket + i * width
        cells.append(Cell(split, lo, lo + width - 1, month, month))
    return cells


@dataclass(frozen=True)
class CohortPlan:
    cells: tuple[Cell, ...]
    buckets: int
    history: int
    predict: int
    hash_kind: str = "murmur3"

    # -- building ----------------------------------------------------------------------------

    @classmethod
    def training(cls, s: CohortSettings) -> CohortPlan:
        train = _blocks("train", s.train_from, s.train_months, s.train_bucket, s.train_width)
        test = _blocks("test", s.test_from, s.test_months, s.test_bucket, s.test_width)
        plan = cls(tuple(train + test), s.buckets, s.history_months, s.predict_months, s.hash_kind)
        plan.check_disjoint()
        return plan

    @classmethod
    def scoring(cls, s: ScoringSettings) -> CohortPlan:
        cells = _blocks("score", s.report_from, s.report_months, s.first_bucket, s.width)
        return cls(tuple(cells), s.buckets, s.history_months, 0, s.hash_kind)

    @classmethod
    def from_dict(cls, saved: dict, hash_kind: str = "murmur3") -> CohortPlan:
        """Read a saved plan: bucket borders and report month borders, listed by position."""

        def cells(split: str, part: dict) -> list[Cell]:
            return [
                Cell(split, lo, hi, month_end(first), month_end(last))
                for (lo, hi), (first, last) in zip(
                    part["epk_bins_borders_list"], part["report_dt_borders_list"]
                )
            ]

        found = [cell for split in ("train", "test") if split in saved for cell in cells(split, saved[split])]
        return cls(
            tuple(found or cells("all", saved)),
            saved["number_of_epk_bins"],
            saved["count_history_months"],
            saved["count_predict_months"],
            hash_kind,
        )

    def to_dict(self) -> dict:
        """The saved form that :meth:`from_dict` reads."""

        def part(cells: tuple[Cell, ...]) -> dict:
            return {
                "count_predict_months": self.predict,
                "count_history_months": self.history,
                "number_of_epk_bins": self.buckets,
                "report_dt_borders_list": [[str(c.report_from), str(c.report_to)] for c in cells],
                "epk_bins_borders_list": [[c.bin_lo, c.bin_hi] for c in cells],
            }

        splits = dict.fromkeys(cell.split for cell in self.cells)
        return part(self.cells) | {s: part(self.only(s).cells) for s in splits}

    def check_disjoint(self) -> None:
        """A client must not serve both training and testing."""
        for cell in self.cells:
            if cell.bin_hi >= self.buckets or cell.bin_lo < 0:
                raise ValueError(f"{cell} lies outside the {self.buckets} buckets")
        for a in self.only("train").cells:
            for b in self.only("test").cells:
                if a.bin_lo <= b.bin_hi and b.bin_lo <= a.bin_hi:
                    raise ValueError(f"train and test share buckets: {a}, {b}")

    # -- reading -----------------------------------------------------------------------------

    def only(self, split: str) -> CohortPlan:
        return replace(self, cells=tuple(c for c in self.cells if c.split == split))

    def window(self, cell: Cell, kind: str = LEDGER_WINDOW) -> tuple[dt.date, dt.date]:
        """First and last month a cell needs from the ledger, or from the profile."""
        if kind == PROFILE_WINDOW:
            return cell.report_from, cell.report_to
        return month_end(cell.report_from, 1 - self.history), month_end(cell.report_to, self.predict)

    def envelope(self, kind: str = LEDGER_WINDOW) -> tuple[dt.date, dt.date]:
        """Months outside this range belong to no cell; a plain range the scan can push down."""
        windows = [self.window(cell, kind) for cell in self.cells]
        return min(lo for lo, _ in windows), max(hi for _, hi in windows)

    def report_months(self) -> list[dt.date]:
        return sorted({month for cell in self.cells for month in cell.months()})

    def months(self) -> list[dt.date]:
        """Every month that some cell touches."""
        return sorted({m for cell in self.cells for m in month_range(*self.window(cell))})

    # -- as tables ---------------------------------------------------------------------------

    def cells_frame(self, spark: SparkSession) -> DataFrame:
        rows = sorted(
            {
                (c.split, c.bin_lo, c.bin_hi, c.report_from, c.report_to, *self.window(c))
                for c in self.cells
            }
        )
        ddl = "split string, bin_lo bigint, bin_hi bigint, report_from date, report_to date, win_lo date, win_hi date"
        return local_table(spark, rows, ddl)

    def lookup_rows(self) -> int:
        """Upper bound of the rows of :meth:`buckets_frame`, known without running anything."""
        return sum((c.bin_hi - c.bin_lo + 1) * len(c.months()) for c in self.cells)

    def buckets_frame(self, spark: SparkSession) -> DataFrame:
        """Distinct ``(bucket, cohort_dt)``: the report months of every bucket."""
        pairs = {
            (bucket, month)
            for cell in self.cells
            for month in cell.months()
            for bucket in range(cell.bin_lo, cell.bin_hi + 1)
        }
        return local_table(spark, sorted(pairs), "bucket bigint, cohort_dt date")

    def bucket_windows_frame(self, spark: SparkSession, kind: str) -> DataFrame:
        """Distinct ``(bucket, win_lo, win_hi)``: the months wanted of every bucket."""
        rows = {
            (bucket, *self.window(cell, kind))
            for cell in self.cells
            for bucket in range(cell.bin_lo, cell.bin_hi + 1)
        }
        return local_table(spark, sorted(rows), "bucket bigint, win_lo date, win_hi date")

    def months_frame(self, spark: SparkSession) -> DataFrame:
        return local_table(spark, [(m,) for m in self.months()], "report_dt date")
