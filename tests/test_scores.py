import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgercast.operators import calibration as C, combine as K, evaluate as E
from ledgercast.operators.running import RANGE, in_ranges, running_totals
from ledgercast.plans import fixtures as fx


def scores(spark, pairs, product="A"):
    return spark.createDataFrame([(product, float(s), int(t)) for s, t in pairs], "product string, score double, target long")


def table(frame):
    return {r["bin"]: r for r in frame.collect()}


def twenty():
    return [(round(0.05 * (i + 1), 2), int(i >= 10)) for i in range(20)]


def test_calibration_by_bin(spark):
    bins = table(C.calibration_fit(scores(spark, twenty())))
    assert len(bins) == 10
    assert all(bins[i]["coef"] == 1 for i in range(5))
    assert bins[5]["coef"] == pytest.approx(1 / 0.575) and bins[9]["coef"] == pytest.approx(1 / 0.975)
    assert bins[0]["lo"] == 0 and bins[9]["hi"] == 1
    assert all(bins[i]["hi"] == bins[i + 1]["lo"] for i in range(9))


def test_constant_score_shares_one_coefficient(spark):
    bins = table(C.calibration_fit(scores(spark, [(0.2, 1), (0.2, 0), (0.2, 0)])))
    assert len(bins) == 10 and all(r["coef"] == pytest.approx(1 / 0.6) for r in bins.values())
    assert (bins[3]["lo"], bins[3]["hi"]) == (0.3, 0.4)


def test_no_positives_leave_scores_alone(spark):
    assert C.calibration_default(scores(spark, [(0.2, 0), (0.3, 0)])).first()["coef"] == 1


def test_gap_between_bins(spark):
    source = scores(spark, twenty())
    at = 0.6 + 0.02  # between the end of bin 5 and the start of bin 6
    for mode, expected in (("observed", 0.0), ("contiguous", at / 0.575)):
        fitted = C.load_calibration(C.calibration_fit(source, mode=mode), ["A"])
        got = spark.range(1).select(C.calibrated(F.lit(at), fitted["A"])).first()[0]
        assert got == pytest.approx(expected), mode


def test_border_scores(spark):
    fitted = C.load_calibration(C.calibration_fit(scores(spark, twenty())), ["A"])
    value = lambda s: spark.range(1).select(C.calibrated(F.lit(s), fitted["A"])).first()[0]
    assert value(1.0) == pytest.approx(1 / 0.975)
    assert value(0.0) == 0 and value(1.5) == 0


@pytest.mark.parametrize("digits", [6, 2, 1])
def test_bins_match_pandas(spark, digits):
    rng = random.Random(digits)
    pairs = [(round(rng.random() ** 3, digits), rng.random() < 0.3) for _ in range(503)]
    got = C.score_quantile_bins(scores(spark, pairs)).select("score", "bin").distinct().toPandas()
    frame = pd.DataFrame({"score": [p[0] for p in pairs]})
    frame["want"] = pd.qcut(frame["score"], 10, labels=False, duplicates="drop")
    both = frame.drop_duplicates().merge(got, on="score")
    # an edge that was dropped as a repeat of the smallest value does not open a bin
    assert len(both) == frame["score"].nunique()
    assert (both.sort_values("score")["bin"].diff().fillna(0) >= 0).all()
    renumbered = both["bin"].rank(method="dense").astype(int) - 1
    assert (renumbered == both["want"].rank(method="dense").astype(int) - 1).all()


def brute_auc(pairs):
    positives = [s for s, t in pairs if t]
    negatives = [s for s, t in pairs if not t]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    return wins / (len(positives) * len(negatives))


def test_auc_known(spark):
    pairs = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)]
    assert E.roc_auc(scores(spark, pairs)).first()["roc_auc"] == 0.75


def test_auc_with_ties_matches_brute_force_and_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(5)
    pairs = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    source = scores(spark, pairs)
    row = E.classification_metrics(source).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(pairs))
    labelled = source.withColumn("target", F.col("target").cast("double"))
    for name, metric in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        reference = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target", metricName=metric, numBins=0)
        assert row[name] == pytest.approx(reference.evaluate(labelled)), name


def test_auc_without_one_class_is_null(spark):
    assert E.roc_auc(scores(spark, [(0.1, 0), (0.2, 0)])).first()["roc_auc"] is None


def running_rows():
    """``B`` holds nearly all rows, and half of its values sit in a sliver of the range; a null group, a null order
    and a null value, and 300 groups of one row."""
    rng = random.Random(1)
    values = {("A", rng.random()) for _ in range(30)} | {(None, rng.random()) for _ in range(20)} | {("A", None)}
    values |= {("B", rng.random() * (1 if i % 2 else 1e-6)) for i in range(900)} | {(f"c{i}", 0.5) for i in range(300)}
    rows = sorted(values, key=lambda v: (v[0] or "", -1.0 if v[1] is None else v[1]))
    return [(g, x, None if k % 97 == 5 else rng.randint(0, 5), rng.randint(1, 9)) for k, (g, x) in enumerate(rows)]


@pytest.mark.parametrize("ranges", [1, 2, 7, 200, None])
def test_running_totals_are_exact_for_any_cuts(spark, ranges):
    rows = running_rows()
    frame = spark.createDataFrame(rows, "g string, x double, n long, m long").repartition(6)
    dealt = in_ranges(frame, "g", "x", "running", ranges)
    result = running_totals(dealt, "g", "x", ["n", "m"])
    assert set(result.columns) == {"g", "x", "n", "m", "n_upto", "n_total", "m_upto", "m_total"}
    got = {(r["g"], r["x"]): (r["n_upto"], r["n_total"], r["m_upto"], r["m_total"]) for r in result.collect()}
    assert len(got) == len(rows)
    for group in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == group]
        n = m = 0
        for g, x, a, b in mine:
            n, m = n + (a or 0), m + b
            assert got[g, x] == (n, sum(r[2] or 0 for r in mine), m, sum(r[3] for r in mine))


def test_running_totals_spread_one_large_group(spark):
    """One group of all rows is dealt over the ranges, and no window gathers it: each is cut by range as well."""
    frame = spark.range(20_000).select(F.lit("B").alias("g"), (F.col("id") * 7919 % 20_000).alias("x"), F.lit(1).cast("long").alias("n"))
    dealt = in_ranges(frame, "g", "x", "running", 8)
    sizes = [r["count"] for r in dealt.groupBy(RANGE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    result = running_totals(dealt, "g", "x", ["n"])
    assert result.where("n_upto != x + 1 or n_total != 20000").isEmpty()
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    inside = [line for line in plan.splitlines() if "Window" in line and "_row" in line]
    assert inside and all(f"[g#" in line and f"{RANGE}#" in line.split("], [")[1] for line in inside)


def test_running_totals_of_nothing(spark):
    frame = spark.createDataFrame([], "g string, x double, n long")
    assert running_totals(in_ranges(frame, "g", "x", "running"), "g", "x", ["n"]).collect() == []


def test_regression_metrics(spark):
    frame = spark.createDataFrame([("A", 1.0, 2.0), ("A", 3.0, 3.0), ("B", 0.0, 1.0)], "product string, target double, predict double")
    rows = {r["product"]: r for r in E.regression_metrics(frame, ["product"]).collect()}
    assert rows["A"]["mae"] == 0.5 and rows["A"]["rmse"] == pytest.approx(math.sqrt(0.5)) and rows["A"]["sum"] == 1.25
    assert rows["B"]["sum"] is None


def test_total_is_the_sum_of_products(spark, sf):
    wide = fx.scores(spark, sf)
    table_ = C.load_calibration(C.calibration_fit(E.sale_scores(wide, fx.PRODUCTS)), fx.PRODUCTS)
    combined = K.combine(wide, table_, fx.PRODUCTS)
    total = sum(F.col(f"`{p}_total_pl_predict`") for p in fx.PRODUCTS)
    assert combined.select(F.max(F.abs(total - F.col("total_pl_predict")))).first()[0] < 1e-6
    for p in fx.PRODUCTS[:2]:
        rich = combined.where(f"`{p}_pl_-1` != 0 and `{p}_total_pl_predict` != `{p}_rich_pl_predict`")
        poor = combined.where(f"`{p}_pl_-1` = 0 and `{p}_total_pl_predict` != `{p}_poor_mix_pl_predict`")
        assert rich.isEmpty() and poor.isEmpty()


def test_product_without_history_scores_zero(spark):
    frame = spark.createDataFrame([(None, 0.5, 1.0, 2.0)], "`A_pl_-1` double, `A_poor_mix_pl_predict` double, `A_rich_pl_predict` double, x double")
    assert frame.select(K.product_total_prediction("A")).first()[0] == 0
