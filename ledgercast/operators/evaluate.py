"""Model quality against the naive forecast, as one long table of metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgercast.operators.calibration import score_counts
from ledgercast.operators.combine import naive_year
from ledgercast.operators.running import running_totals
from ledgercast.operators.targets import is_poor, is_poor_sold, is_rich


def ratio_of_sums(predict: Column, target: Column) -> Column:
    """Null where the targets add up to 0."""
    return F.try_divide(F.sum(predict), F.sum(target))


def regression_metrics(df: DataFrame, by: list[str], target: str = "target", predict: str = "predict") -> DataFrame:
    """``mae``, ``rmse`` and ``sum`` (ratio of sums) per group, in one aggregation."""
    t, p = F.col(f"`{target}`").cast("double"), F.col(f"`{predict}`").cast("double")
    return df.groupBy(*by).agg(
        F.avg(F.abs(p - t)).alias("mae"),
        F.sqrt(F.avg((p - t) * (p - t))).alias("rmse"),
        ratio_of_sums(p, t).alias("sum"),
    )


# -- ranking metrics -----------------------------------------------------------------------------


def score_curve(scores: DataFrame) -> DataFrame:
    """True and false positives from the highest score down, one row per distinct score."""
    counts = score_counts(scores)
    steps = counts.withColumn("negatives", F.col("n") - F.col("positives")).drop("n")
    ranked = running_totals(steps, "product", "score", ["positives", "negatives"])
    above = {
        f"{kind}_above": F.col(f"{kind}_total") - F.col(f"{kind}_upto") for kind in ("positives", "negatives")
    }
    return ranked.withColumns(above)


def _roc_auc() -> Column:
    """Each negative counts the positives above it, and half of those beside it."""
    area = F.sum(F.col("negatives") * (F.col("positives_above") + F.col("positives") / 2))
    pairs = F.max("positives_total").cast("double") * F.max("negatives_total")
    return F.try_divide(area, pairs)


def _pr_auc() -> Column:
    """Trapezoids between recall steps; the curve starts level at its first precision."""
    tp, fp = F.col("positives_above"), F.col("negatives_above")
    tp_now, fp_now = tp + F.col("positives"), fp + F.col("negatives")
    precision = tp_now / (tp_now + fp_now)
    previous = F.when(tp + fp == 0, precision).otherwise(F.try_divide(tp, tp + fp))
    area = F.sum(F.col("positives") * (precision + previous) / 2)
    return F.try_divide(area, F.max("positives_total").cast("double"))


def classification_metrics(scores: DataFrame) -> DataFrame:
    """``roc_auc``, ``pr_auc`` and ``sum`` per product of ``(product, score, target)``."""
    curve = score_curve(scores)
    return curve.groupBy("product").agg(
        _roc_auc().alias("roc_auc"),
        _pr_auc().alias("pr_auc"),
        F.try_divide(
            F.sum(F.col("score") * (F.col("positives") + F.col("negatives"))), F.max("positives_total")
        ).alias("sum"),
    )


def roc_auc(scores: DataFrame) -> DataFrame:
    return score_curve(scores).groupBy("product").agg(_roc_auc().alias("roc_auc"))


def pr_auc(scores: DataFrame) -> DataFrame:
    return score_curve(scores).groupBy("product").agg(_pr_auc().alias("pr_auc"))


# -- long forms ----------------------------------------------------------------------------------

PRODUCT_COLUMNS = {
    "pl_-1": "{p}_pl_-1",
    "pl_target": "{p}_pl_target",
    "sale": "{p}_sales_pl_target",
    "rich": "{p}_rich_pl_predict",
    "poor": "{p}_poor_pl_predict",
    "probability": "{p}_sales_pl_predict_probability",
    "mix": "{p}_poor_mix_pl_predict",
    "product_total": "{p}_total_pl_predict",
}


def by_product(wide: DataFrame, products: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """One row per client, month and product, from the columns present; no exchange."""
    columns = {
        name: pattern
        for name, pattern in (columns or PRODUCT_COLUMNS).items()
        if pattern.format(p=products[0]) in wide.columns
    }
    cells = [
        ", ".join([f"'{p}'", *[f"cast(`{pattern.format(p=p)}` AS double)" for pattern in columns.values()]])
        for p in products
    ]
    names = ", ".join(f"`{name}`" for name in ["product", *columns])
    return wide.selectExpr("epk_id", "report_dt", f"stack({len(products)}, {', '.join(cells)}) AS ({names})")


def sale_scores(wide: DataFrame, products: list[str]) -> DataFrame:
    """``(product, score, target)`` of the poor clients."""
    return by_product(wide, products).where(is_poor()).select(
        "product", F.col("probability").alias("score"), F.col("sale").cast("long").alias("target")
    )


PARTS: dict[str, tuple] = {
    "rich_regression_model": (is_rich, "rich"),
    "rich_regression_naive": (is_rich, "pl_-1"),
    "poor_regression_model": (is_poor_sold, "poor"),
    "poor_mix_model": (is_poor, "mix"),
    "poor_mix_naive": (is_poor, "pl_-1"),
    "product_total_model": (lambda: F.lit(True), "product_total"),
    "product_total_naive": (lambda: F.lit(True), "pl_-1"),
    "product_total_naive_year": (lambda: F.lit(True), "naive_year"),
}


def product_metrics(combined: DataFrame, products: list[str], parts: list[str] | None = None) -> DataFrame:
    """``(product, part, mae, rmse, sum)`` of the chosen parts; a part is a segment and a forecast.

    ``naive`` is one month of P&L against a year; ``naive_year`` twelve times that month.
    """
    rows = by_product(combined, products).withColumn("naive_year", F.col("`pl_-1`") * 12)
    chosen = {name: PARTS[name] for name in parts or PARTS}
    return _metrics_of_parts(rows, ["product"], {n: (keep(), "pl_target", F.col(f"`{c}`")) for n, (keep, c) in chosen.items()})


def total_metrics(combined: DataFrame) -> DataFrame:
    """``(part, mae, rmse, sum)``: sum of product forecasts, the single total model, the naive year."""
    forecasts = {
        "total_mix_model": F.col("total_pl_predict"),
        "total_single_model": F.col("AllProducts_total_pl_predict"),
        "total_naive_year": naive_year(),
    }
    return _metrics_of_parts(combined, [], {n: (F.lit(True), "total_pl_target", c) for n, c in forecasts.items()})


def _metrics_of_parts(df: DataFrame, by: list[str], parts: dict[str, tuple[Column, str, Column]]) -> DataFrame:
    """``(*by, part, mae, rmse, sum)``: a part has a condition, a target and a forecast.

    All parts are measured side by side in one aggregation, whose few rows are then turned; a part
    without rows is left out.
    """
    aggregates = []
    for i, (keep, target, predict) in enumerate(parts.values()):
        t, p = F.when(keep, F.col(target).cast("double")), F.when(keep, predict.cast("double"))
        aggregates += [
            F.avg(F.abs(p - t)).alias(f"mae_{i}"),
            F.sqrt(F.avg((p - t) * (p - t))).alias(f"rmse_{i}"),
            ratio_of_sums(p, t).alias(f"sum_{i}"),
            F.count_if(keep).alias(f"n_{i}"),
        ]
    cells = ", ".join(f"'{name}', mae_{i}, rmse_{i}, sum_{i}, n_{i}" for i, name in enumerate(parts))
    turned = df.groupBy(*by).agg(*aggregates).selectExpr(*by, f"stack({len(parts)}, {cells}) AS (part, mae, rmse, sum, n)")
    return turned.where("n > 0").drop("n")


def as_long(metrics: DataFrame, scope: str, names: list[str]) -> DataFrame:
    """``(scope, product, part, metric, value)``."""
    product = F.col("product") if "product" in metrics.columns else F.lit("all")
    part = F.col("part") if "part" in metrics.columns else F.lit("poor_classification_model")
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return metrics.select(
        F.lit(scope).alias("scope"), product.alias("product"), part.alias("part"), F.explode(pairs).alias("x")
    ).select("scope", "product", "part", "x.*")


def evaluate(combined: DataFrame, products: list[str]) -> DataFrame:
    """All quality metrics of combined scores in one long table.

    Reads ``combined`` three times; stage it first when it comes from models.
    """
    regression = ["mae", "rmse", "sum"]
    return (
        as_long(product_metrics(combined, products), "test", regression)
        .union(as_long(classification_metrics(sale_scores(combined, products)), "test", ["roc_auc", "pr_auc", "sum"]))
        .union(as_long(total_metrics(combined), "test", regression))
    )
