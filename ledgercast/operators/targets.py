"""Targets, sale flags, totals and client segments, as expressions on wide or long frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.dimensions import Dimensions
from ledgercast.functions.money import exact_sum, units_as
from ledgercast.operators.ledger import KEYS, NOW, client_cells, cohort_rows, feature_names, other_columns, widen
from ledgercast.plans.cohort_plan import CohortPlan


def now(product: str | None = None) -> str:
    """Column of the report month's P&L; without a product, of the long form."""
    return f"{product}_pl_-1" if product else "pl_-1"


def target(product: str | None = None) -> str:
    return f"{product}_pl_target" if product else "pl_target"


# -- segments ------------------------------------------------------------------------------------


def is_rich(product: str | None = None) -> Column:
    """The product earned or cost something in the report month."""
    return F.col(f"`{now(product)}`") != 0


def is_poor(product: str | None = None) -> Column:
    return F.col(f"`{now(product)}`") == 0


def is_poor_sold(product: str | None = None) -> Column:
    """Nothing in the report month, something over the year ahead."""
    return is_poor(product) & (F.col(f"`{target(product)}`") != 0)


SEGMENTS = {"rich": is_rich, "poor": is_poor, "poor_sold": is_poor_sold, "all": lambda product=None: F.lit(True)}


def segment(df: DataFrame, name: str, product: str | None = None) -> DataFrame:
    return df.where(SEGMENTS[name](product))


# -- targets -------------------------------------------------------------------------------------


def product_target(wide: DataFrame, products: list[str], predict: int) -> DataFrame:
    """Replace the predicted months of each product by their sum; nothing to do without months."""
    if predict == 0:
        return wide
    months = {p: [f"{p}_pl_{m}" for m in range(predict)] for p in products}
    gone = {name for names in months.values() for name in names}
    sums = [exact_sum([F.col(f"`{c}`") for c in months[p]]).alias(target(p)) for p in products]
    return wide.select(*[f"`{c}`" for c in wide.columns if c not in gone], *sums)


def sale_flag(product: str | None = None) -> Column:
    return F.when(is_poor_sold(product), F.lit(1)).otherwise(F.lit(0))


def sale_flags(wide: DataFrame, products: list[str]) -> DataFrame:
    return wide.withColumns({f"{p}_sales_pl_target": sale_flag(p) for p in products})


def total_of(names: list[str]) -> Column:
    return exact_sum([F.col(f"`{name}`") for name in names])


def total_naive_and_target(wide: DataFrame, products: list[str]) -> DataFrame:
    """Report-month and year-ahead totals over products."""
    return wide.withColumns(
        {
            "total_pl_-1": total_of([now(p) for p in products]),
            "total_pl_target": total_of([target(p) for p in products]),
        }
    )


def scoring_total_naive(wide: DataFrame, products: list[str]) -> DataFrame:
    """Report-month total only: in scoring the year ahead is unknown."""
    return wide.withColumn("total_pl_-1", total_of([now(p) for p in products]))


# -- the ledger dataset --------------------------------------------------------------------------


def dataset_of_cells(df: DataFrame, plan: CohortPlan, dims: Dimensions) -> DataFrame:
    """Ledger features with targets, flags and totals, behind the other columns.

    The year ahead is summed in the first aggregation, so the single months are never shuffled.
    """
    products = dims.product_names
    items = feature_names(plan, dims)[: -len(products)]
    parts = [(NOW, now)] + ([("f_sum", target)] if plan.predict > 0 else [])
    columns = [units_as(f"{p}|{part}", name(p)) for part, name in parts for p in products]
    totals = ["(" + " + ".join(f"`{p}|{part}`" for p in products) + f") AS `{name('total')}`" for part, name in parts]
    out = widen(df, plan, dims).selectExpr("*", *totals).selectExpr(
        *other_columns(df), *[f"`{c}`" for c in items], *columns, *[units_as(name("total"), name("total")) for _, name in parts]
    )
    return sale_flags(out, products) if plan.predict > 0 else out


def pnl_dataset(ledger: DataFrame, plan: CohortPlan, dims: Dimensions, sample: DataFrame | None = None) -> DataFrame:
    """The ledger dataset of each client and report month."""
    return dataset_of_cells(client_cells(cohort_rows(ledger, plan, dims), plan, dims, sample=sample), plan, dims)


@dataclass(frozen=True)
class ColumnGroups:
    """Which columns of the ledger dataset are features, targets, flags and naive forecasts."""

    features: list[str]
    targets: list[str]
    flags: list[str]
    naive: list[str]
    total_target: list[str]
    total_naive: list[str]

    def outcomes(self) -> list[str]:
        return self.targets + self.flags + self.naive + self.total_target + self.total_naive


def column_groups(columns: list[str]) -> ColumnGroups:
    """Split columns by name."""
    rest = [c for c in columns if c not in KEYS]
    totals = [c for c in rest if c.startswith("total_pl_")]
    flags = [c for c in rest if c.endswith("_sales_pl_target")]
    rest = [c for c in rest if c not in totals and c not in flags]
    return ColumnGroups(
        features=[c for c in rest if "target" not in c],
        targets=[c for c in rest if "target" in c],
        flags=flags,
        naive=[c for c in rest if c.endswith("_pl_-1")],
        total_target=[c for c in totals if "target" in c],
        total_naive=[c for c in totals if "target" not in c],
    )


def drop_targets(scores: DataFrame) -> DataFrame:
    return scores.select(*[f"`{c}`" for c in scores.columns if "target" not in c])
