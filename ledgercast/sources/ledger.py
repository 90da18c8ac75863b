"""Ledger source: one row per client, product code, month and item code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgercast.functions.money import as_money

COLUMNS = ["epk_id", "report_dt", "product_cd", "pl_item", "pl_val"]


def open_table(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A DataFrame as it is, a path with a slash as Parquet, any other name as a catalog table."""
    if isinstance(source, DataFrame):
        return source
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def stored_range(df: DataFrame, column: str, months: tuple[dt.date, dt.date]) -> Column:
    """A range on months as they are stored, which a scan can prune files by; the exact range follows on dates.

    Text is bounded by its year: all ways to write a date that can be read as one begin with it, but for signs and
    blanks, which sort before digits and are let through.
    """
    stored, (first, last) = F.col(column), months
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return stored.between(str(first.year), f"{last.year}~") | (stored < "0")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        after = F.lit(last + dt.timedelta(days=1))
        return (stored >= F.lit(first).cast(kind)) & (stored < after.cast(kind))
    return stored.between(F.lit(first), F.lit(last)) if isinstance(kind, T.DateType) else F.lit(True)


def with_dates(df: DataFrame, column: str = "report_dt", months: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Months as DATE; sources may keep them as text or with a time. ``months`` are those that are asked for."""
    if months:
        df = df.where(stored_range(df, column, months))
    if isinstance(df.schema[column].dataType, T.DateType):
        return df
    return df.withColumn(column, F.col(column).cast("date"))


def scan_ledger(spark: SparkSession, source: str | DataFrame, months: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    ledger = open_table(spark, source).withColumnsRenamed({"client_id": "epk_id", "report_date": "report_dt"})
    return as_money(with_dates(ledger.select(*COLUMNS), months=months), "pl_val")


def scan_client_sample(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    return open_table(spark, source).select("epk_id")
