"""Cohort filters: keep the rows of the clients and months a plan asks for.

The plan joins on the bucket number as a hash join with a small lookup table; the outer month
range goes in front as a plain predicate, which a Parquet scan prunes partitions and row groups by.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.functions.bucket import client_bucket, positive_hash
from ledgercast.functions.calendar import month_index
from ledgercast.plans.cohort_plan import LEDGER_WINDOW, PROFILE_WINDOW, CohortPlan
from ledgercast.sources.local_table import broadcast_if_small


def in_months(column: str, bounds: tuple[dt.date, dt.date]) -> Column:
    return F.col(column).between(F.lit(bounds[0]), F.lit(bounds[1]))


def _filter(df: DataFrame, plan: CohortPlan, kind: str) -> DataFrame:
    lookup = plan.bucket_windows_frame(df.sparkSession, kind)
    wanted = (F.col("_bucket") == F.col("bucket")) & F.col("report_dt").between(
        F.col("win_lo"), F.col("win_hi")
    )
    return (
        df.where(in_months("report_dt", plan.envelope(kind)))
        .withColumn("_bucket", client_bucket(F.col("epk_id"), plan.buckets, plan.hash_kind))
        .join(broadcast_if_small(lookup, plan.lookup_rows()), wanted, "left_semi")
        .drop("_bucket")
    )


def cohort_filter_ledger(ledger: DataFrame, plan: CohortPlan) -> DataFrame:
    """Rows whose month lies in the history or prediction window of the client's cell."""
    return _filter(ledger, plan, LEDGER_WINDOW)


def cohort_filter_profile(profile: DataFrame, plan: CohortPlan) -> DataFrame:
    """Rows whose month is a report month of the client's cell."""
    return _filter(profile, plan, PROFILE_WINDOW)


def cohort_split(dataset: DataFrame, plan: CohortPlan) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a dataset."""
    return (
        cohort_filter_profile(dataset, plan.only("train")),
        cohort_filter_profile(dataset, plan.only("test")),
    )


def with_cohort_month(df: DataFrame, plan: CohortPlan) -> DataFrame:
    """Attach each report month of the client's cells and the row's month offset to it.

    Adds ``cohort_dt`` and ``offset`` (0 = the report month, negative = history) and keeps the
    offsets from ``1 - H`` to ``P``.
    """
    lookup = plan.buckets_frame(df.sparkSession)
    offset = month_index(F.col("report_dt")) - month_index(F.col("cohort_dt"))
    return (
        df.where(in_months("report_dt", plan.envelope()))
        .withColumn("bucket", client_bucket(F.col("epk_id"), plan.buckets, plan.hash_kind))
        .join(broadcast_if_small(lookup, plan.lookup_rows()), "bucket")
        .drop("bucket")
        .withColumn("offset", offset)
        .where(F.col("offset").between(1 - plan.history, plan.predict))
    )


def cohort_months(ranges: DataFrame, first: str, last: str, history: int, predict: int) -> DataFrame:
    """Distinct months in the windows of all report months from ``first`` to ``last``, sorted.

    Windows of neighbouring months overlap, so their union is one range per row.
    """
    start = F.last_day(F.add_months(F.last_day(F.col(first)), 1 - history))
    stop = F.last_day(F.add_months(F.last_day(F.col(last)), predict))
    others = [c for c in ranges.columns if c not in (first, last)]
    months = ranges.select(*others, F.explode(F.sequence(start, stop, F.expr("interval 1 month"))).alias("m"))
    return months.select(*others, F.last_day("m").alias("report_dt")).distinct().orderBy(*others, "report_dt")


def validation_flag(dataset: DataFrame, hash_kind: str = "murmur3") -> DataFrame:
    """Mark about a fifth of the client-months as validation rows, by hash."""
    key = F.concat(F.col("report_dt").cast("string"), F.col("epk_id").cast("string"))
    return dataset.withColumn("is_valid", positive_hash(key, hash_kind) % 5 == 4)


def validation_rows(dataset: DataFrame, valid: bool = True) -> DataFrame:
    return dataset.where(F.col("is_valid") == F.lit(valid))


def in_sample(fraction: float, seed: int, hash_kind: str = "murmur3") -> Column:
    """True for a fraction of the client-months, by hash: the same ones under any partitioning."""
    key = F.concat_ws("|", F.lit(str(seed)), F.col("report_dt").cast("string"), F.col("epk_id").cast("string"))
    return positive_hash(key, hash_kind) % 10_000 < int(round(fraction * 10_000))


def sample_rows(df: DataFrame, fraction: float, seed: int, hash_kind: str = "murmur3") -> DataFrame:
    return df.where(in_sample(fraction, seed, hash_kind))


HASH_BITS, STEP_BITS = 64, 16


def bottom_rows(df: DataFrame, most: int, seed: int) -> DataFrame:
    """The ``most`` rows with the smallest hashes of seed, month and client: the same under any partitioning.

    All rows where there are no more. The limit on the hash is found from counts per stretch of hashes, 65,536
    of them, and of the stretch where ``most`` is passed anew, four times at worst. Rows that share client and
    month, and so the hash, are taken together or not at all, so the sample can be smaller by such a group.
    """
    hashed = F.xxhash64(F.lit(seed), "report_dt", "epk_id")
    taken, low, shift = 0, None, HASH_BITS - STEP_BITS
    while True:
        stretch = F.shiftright(hashed, shift)
        inside = df if low is None else df.where(F.shiftright(hashed, shift + STEP_BITS) == low)
        counts = inside.groupBy(stretch.alias("stretch")).count().orderBy("stretch").toArrow()  # at most 65,536 rows
        stretches, sums = counts["stretch"].to_numpy(), taken + np.cumsum(counts["count"].to_numpy())
        within = int(np.searchsorted(sums, most, side="right"))
        if within == len(sums):
            return df if low is None else df.where(F.shiftright(hashed, shift + STEP_BITS) <= low)
        taken, low = int(sums[within - 1]) if within else taken, int(stretches[within])
        if shift == 0 or taken == most:
            return df.where(F.shiftright(hashed, shift) < low)
        shift -= STEP_BITS
