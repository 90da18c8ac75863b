"""Statistics of one history row, from the oldest month to the newest."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# Fixed value: what stands in for a mean of zero in a denominator.
ZERO_MEAN = 0.0001

STATISTICS = [
    "mean", "min", "max", "scatter",
    "delta_abs_mean", "delta_abs_min", "delta_abs_max",
    "delta_relative_mean", "delta_relative_min", "delta_relative_max",
]


def history_columns(history: int) -> list[str]:
    """``item_-H`` … ``item_-1``."""
    return [f"item_-{k}" for k in range(history, 0, -1)]


def row_mean(columns: list[Column]) -> Column:
    return reduce(add, columns) / F.lit(float(len(columns)))


def guarded(mean: Column) -> Column:
    return F.when(mean == 0, F.lit(ZERO_MEAN)).otherwise(mean)


def base_statistics(history: int) -> dict[str, Column]:
    """Mean, smallest and largest month. A history of one month has no statistics."""
    if history < 2:
        return {}
    columns = [F.col(f"`{name}`") for name in history_columns(history)]
    return {"mean": row_mean(columns), "min": F.least(*columns), "max": F.greatest(*columns)}


def derived_statistics(history: int) -> dict[str, Column]:
    """Spread and deltas of the newest month, over the columns of :func:`base_statistics`."""
    if history < 2:
        return {}
    newest = F.col("`item_-1`")
    deltas = {
        "mean": newest - F.col("mean"),
        "min": newest - F.col("`item_-2`"),
        "max": newest - F.col(f"`item_-{history}`"),
    }
    scale = guarded(F.col("mean"))
    out = {"scatter": (F.col("max") - F.col("min")) / scale}
    out |= {f"delta_abs_{name}": delta for name, delta in deltas.items()}
    out |= {f"delta_relative_{name}": delta / scale for name, delta in deltas.items()}
    return out
