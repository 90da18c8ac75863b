"""Exact money sums.

Money arrives as DECIMAL. Sums run on the unscaled value in a 64-bit integer: exact, no object
buffers in the hash aggregate, and an overflow raises instead of rounding. The value becomes
DOUBLE only after the last sum, so every engine and every partitioning gives the same result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = T.DecimalType(18, 4)


def as_money(df: DataFrame, column: str) -> DataFrame:
    """Bring ``column`` to the common money type."""
    if df.schema[column].dataType == MONEY:
        return df
    return df.withColumn(column, F.col(column).cast(MONEY))


def units(value: Column) -> Column:
    """Ten-thousandths of a currency unit as a long."""
    return (value * F.lit(10 ** MONEY.scale)).cast("long")


def from_units(value: Column) -> Column:
    return value.cast("double") / F.lit(float(10 ** MONEY.scale))


def units_as(column: str, name: str) -> str:
    """SQL form of :func:`from_units`, for selects of very many columns."""
    return f"cast(`{column}` AS double) / {float(10 ** MONEY.scale)}D AS `{name}`"


def exact_sum(columns: list[Column]) -> Column:
    """Row-wise sum of DOUBLE money columns without rounding error."""
    whole = [F.round(c * F.lit(float(10 ** MONEY.scale))).cast("long") for c in columns]
    return from_units(reduce(add, whole))
