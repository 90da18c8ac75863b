"""Combine the scores of a client into product forecasts and one total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.operators.calibration import CalibrationBin, apply_calibration
from ledgercast.operators.targets import is_poor, is_rich

# Fixed value: months in the forecast year.
YEAR = 12


def poor_mix(product: str) -> Column:
    """Calibrated chance of a sale times the value of a sale."""
    return F.col(f"`{product}_sales_pl_predict_probability_calibrated`") * F.col(f"`{product}_poor_pl_predict`")


def product_total_prediction(product: str) -> Column:
    return (
        F.when(is_poor(product), F.col(f"`{product}_poor_mix_pl_predict`"))
        .when(is_rich(product), F.col(f"`{product}_rich_pl_predict`"))
        .otherwise(0.0)
    )


def total_prediction(products: list[str]) -> Column:
    total = F.lit(0.0)
    for p in products:
        total = total + F.col(f"`{p}_total_pl_predict`")
    return total


def naive_year() -> Column:
    return F.col("`total_pl_-1`") * YEAR


def with_poor_mix(df: DataFrame, products: list[str]) -> DataFrame:
    return df.withColumns({f"{p}_poor_mix_pl_predict": poor_mix(p) for p in products})


def with_product_totals(df: DataFrame, products: list[str]) -> DataFrame:
    return df.withColumns({f"{p}_total_pl_predict": product_total_prediction(p) for p in products})


def combine(scores: DataFrame, calibration: dict[str, list[CalibrationBin]], products: list[str]) -> DataFrame:
    """Calibrate, mix, choose per product, add up; row by row, no exchange."""
    mixed = with_poor_mix(apply_calibration(scores, calibration), products)
    return with_product_totals(mixed, products).withColumn("total_pl_predict", total_prediction(products))


def prediction_columns(columns: list[str], outcomes: list[str]) -> list[str]:
    """Keys, outcomes that are present, and scores; features are left behind."""
    scores = [c for c in columns if "_pl_predict" in c]
    return ["epk_id", "report_dt"] + [c for c in outcomes if c in columns] + scores
