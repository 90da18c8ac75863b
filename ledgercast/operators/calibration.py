"""Calibration of sale scores: quantile bins per product and one coefficient per bin.

Scores arrive long, ``(product, score, target)``. Everything is computed from counts per distinct
score, so the work after the first aggregation does not depend on how often a score repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgercast.operators.running import in_ranges, running_totals

BINS = 10
# Fixed value: a coefficient this far from 1 is not trusted.
FAR_FROM_ONE = 0.9999


def score_counts(scores: DataFrame) -> DataFrame:
    """``(product, score, n, positives)``: one row per distinct score, dealt into ranges for ranks.

    Ranks read it several times, so it is staged: the scores behind it are computed once.
    """
    counts = scores.groupBy("product", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("target").cast("long")).alias("positives")
    )
    return in_ranges(counts, "product", "score", "score-counts")


def quantile_edges(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """``(product, edges)``: exact inner quantile edges with linear interpolation.

    Equal edges are one, and an edge at the smallest score closes no bin.
    """
    ranked = running_totals(counts, "product", "score", ["n"])

    def value_at(rank: Column) -> Column:
        holds = (F.col("n_upto") > rank) & (F.col("n_upto") - F.col("n") <= rank)
        return F.max(F.when(holds, F.col("score")))

    picks, edges = [], []
    for k in range(1, bins):
        position = F.lit(k / bins) * (F.col("n_total") - 1)
        picks += [value_at(F.floor(position)).alias(f"_lo{k}"), value_at(F.ceil(position)).alias(f"_hi{k}")]
        at = F.lit(k / bins) * (F.col("_n") - 1)
        lo, hi = F.col(f"_lo{k}"), F.col(f"_hi{k}")
        edges.append(lo + (hi - lo) * (at - F.floor(at)))
    found = ranked.groupBy("product").agg(F.max("n_total").alias("_n"), F.min("score").alias("_least"), *picks)
    inner = F.filter(F.array_distinct(F.array(*edges)), lambda edge: edge > F.col("_least"))
    return found.select("product", inner.alias("edges"))


def score_quantile_bins(scores: DataFrame, bins: int = BINS, counts: DataFrame | None = None) -> DataFrame:
    """Add the number of the right-closed quantile bin of each score."""
    edges = quantile_edges(score_counts(scores) if counts is None else counts, bins)
    number = F.size(F.filter("edges", lambda edge: edge < F.col("score")))
    return scores.join(F.broadcast(edges), "product").withColumn("bin", number.cast("long")).drop("edges")


def calibration_bin_stats(scores: DataFrame, bins: int = BINS) -> DataFrame:
    """Per bin: smallest, largest and mean score, and the target rate."""
    counts = score_counts(scores)
    return _bin_stats(score_quantile_bins(counts, bins, counts))


def _bin_stats(binned: DataFrame) -> DataFrame:
    n = F.sum("n")
    return binned.groupBy("product", "bin").agg(
        F.min("score").alias("score_min"),
        F.max("score").alias("score_max"),
        n.alias("n"),
        F.sum("positives").alias("positives"),
        F.sum(F.col("score") * F.col("n")).alias("score_sum"),
        (F.sum(F.col("score") * F.col("n")) / n).alias("score_mean"),
        (F.sum("positives") / n).alias("target_rate"),
    )


def calibration_default(scores: DataFrame) -> DataFrame:
    """One coefficient per product: targets over scores, 1 if either sum is 0."""
    return scores.groupBy("product").agg(
        _default(F.sum(F.col("target").cast("double")), F.sum("score")).alias("coef")
    )


def _default(targets: Column, scores: Column) -> Column:
    return F.when((targets == 0) | (scores == 0), F.lit(1.0)).otherwise(F.try_divide(targets, scores))


def calibration_fit(scores: DataFrame, bins: int = BINS, mode: str = "contiguous") -> DataFrame:
    """``(product, bin, lo, hi, coef)``.

    With fewer distinct quantile bins than asked for, equal-width bins share the default
    coefficient. Otherwise each bin has its own. ``mode='observed'`` ends a bin at its largest
    observed score, which leaves gaps; ``'contiguous'`` ends it where the next one starts.
    """
    if mode not in ("contiguous", "observed"):
        raise ValueError(f"unknown calibration mode {mode!r}")
    stats = calibration_bin_stats(scores, bins)
    product = Window.partitionBy("product")
    ordered = product.orderBy("bin")
    raw = F.try_divide(F.col("target_rate"), F.col("score_mean"))
    own = F.when(F.col("score_mean") == 0, 1.0).when(F.abs(1 - raw) >= FAR_FROM_ONE, 1.0).otherwise(raw)
    upper = F.col("score_max") if mode == "observed" else F.lead("score_min").over(ordered)
    per_bin = stats.withColumns(
        {
            "found": F.count(F.lit(1)).over(product),
            "default": _default(F.sum("positives").over(product), F.sum("score_sum").over(product)),
            "lo": F.when(F.col("bin") == 0, 0.0).otherwise(F.col("score_min")),
            "hi": F.when(F.col("bin") == bins - 1, 1.0).otherwise(upper),
            "coef": own,
            "first": F.row_number().over(ordered) == 1,
        }
    )

    def row(number: Column, lo: Column, hi: Column, coef: Column) -> Column:
        return F.struct(number.alias("bin"), lo.alias("lo"), hi.alias("hi"), coef.alias("coef"))

    equal_width = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")),
        lambda k: row(k, F.round(k / bins, 2), F.round(k / bins + 1 / bins, 2), F.col("default")),
    )
    rows = F.when(
        F.col("found") == bins, F.array(row(F.col("bin"), F.col("lo"), F.col("hi"), F.col("coef")))
    ).when(F.col("first"), equal_width)
    return per_bin.select("product", F.explode(rows).alias("x")).select("product", "x.*")


@dataclass(frozen=True)
class CalibrationBin:
    lo: float
    hi: float
    coef: float


def load_calibration(table: DataFrame, products: list[str], bins: int = BINS) -> dict[str, list[CalibrationBin]]:
    """The fitted table as parameters: ``bins`` rows per product, none for one without calibration rows."""
    out: dict[str, list[CalibrationBin]] = {p: [] for p in products}
    for row in sorted(table.where(F.col("product").isin(list(out))).collect(), key=lambda r: r["bin"]):
        out[row["product"]].append(CalibrationBin(row["lo"], row["hi"], row["coef"]))
    wrong = {p: len(rows) for p, rows in out.items() if len(rows) not in (0, bins)}
    if wrong:
        raise ValueError(f"calibration needs {bins} rows per product, not {wrong}")
    return out


def calibrated(score: Column, table: list[CalibrationBin]) -> Column:
    """Score times the coefficient of its bin ``[lo, hi)``, the last one closed; 0 outside.

    Without bins the coefficient is 1.
    """
    if not table:
        return score.cast("double")
    expr = F.lit(0.0)
    for position, b in reversed(list(enumerate(table))):
        last = position == len(table) - 1
        below = score <= b.hi if last else score < b.hi
        expr = F.when((score >= b.lo) & below, score * b.coef).otherwise(expr)
    return expr


def apply_calibration(scores: DataFrame, calibration: dict[str, list[CalibrationBin]]) -> DataFrame:
    """Add the calibrated probability of each product, map-side."""
    return scores.withColumns(
        {
            f"{p}_sales_pl_predict_probability_calibrated": calibrated(
                F.col(f"`{p}_sales_pl_predict_probability`"), table
            )
            for p, table in calibration.items()
        }
    )
