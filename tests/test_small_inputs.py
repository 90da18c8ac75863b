"""Small segments, text months, flags and products without calibration rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgercast.operators.calibration import apply_calibration, load_calibration
from ledgercast.operators.models import SearchSettings, fit_model, model_rich
from ledgercast.operators.profile import category_fill
from ledgercast.sources.ledger import scan_ledger
from ledgercast.sources.profile import scan_profile


@pytest.mark.parametrize("count", [0, 1, 5, 20])
def test_small_segments_fit_with_default_samples(spark, count):
    rows = [(i, "2020-01-31", float(i % 7), 1000.0 * (i - 2), 1.0, i % 10 == 9) for i in range(count)]
    schema = "epk_id long, report_dt string, x double, P_pl_target double, `P_pl_-1` double, is_valid boolean"
    data = spark.createDataFrame(rows, schema)
    search = SearchSettings(depths=(2,), steps=(0.1,), iterations=(2, 3), forest_trees=5)
    fitted = fit_model(data, ["x"], model_rich("P"), search)
    scores = [r[0] for r in fitted.model.transform(data).select("P_rich_pl_predict").collect()]
    assert len(scores) == count
    if count == 1:
        assert scores == [-2000.0]
    if count == 5:
        assert min(scores) > -2000.0 or max(scores) > min(scores)


def test_months_as_text_become_dates(spark):
    ledger = spark.createDataFrame([(1, "2020-01-31", 1, 1, "5.5")], "client_id long, report_date string, product_cd int, pl_item int, pl_val string")
    assert dict(scan_ledger(spark, ledger).dtypes)["report_dt"] == "date"
    profile = spark.createDataFrame([(1, "2020-01-31", 2.0)], "epk_id long, report_dt string, x_amt double")
    assert dict(scan_profile(spark, profile).dtypes)["report_dt"] == "date"


def test_flags_and_dates_as_categories(spark):
    df = spark.createDataFrame([(True, "2020-01-01"), (None, None)], "a_nflag boolean, b_cd string").withColumn("b_cd", F.col("b_cd").cast("date"))
    got = df.select(category_fill(df, "a_nflag"), category_fill(df, "b_cd")).collect()
    assert got[0]["a_nflag"] == 1 and got[1]["a_nflag"] == -9876 and got[0]["b_cd"] == "2020-01-01" and got[1]["b_cd"] is not None


def test_product_without_calibration_rows_keeps_its_score(spark):
    table = spark.createDataFrame([("A", 0, 0.0, 0.5, 2.0), ("A", 1, 0.5, 1.0, 1.0), ("Z", 0, 0.0, 1.0, 9.0)], "product string, bin long, lo double, hi double, coef double")
    found = load_calibration(table, ["A", "B"], 2)
    scores = spark.createDataFrame([(0.25, 0.25)], "A_sales_pl_predict_probability double, B_sales_pl_predict_probability double")
    got = apply_calibration(scores, found).first()
    assert got["A_sales_pl_predict_probability_calibrated"] == 0.5 and got["B_sales_pl_predict_probability_calibrated"] == 0.25
    with pytest.raises(ValueError):
        load_calibration(table, ["A"], 3)


def test_stored_months_are_pruned_by_the_scan(spark, tmp_path):
    months = ["2018-12-31", "2019-1-31", " 2020-06-30", "2020-06-30 00:00:00", "2020-07-31", "2021-01-31", None, "x"]
    text = spark.createDataFrame([(k, m, 1, 1, 1.0) for k, m in enumerate(months)], "epk_id long, report_dt string, product_cd int, pl_item int, pl_val double")
    span = (dt.date(2019, 1, 31), dt.date(2020, 6, 30))
    whole = text.where(F.expr("try_cast(report_dt AS date)").isNotNull())
    stored = {"text": whole, "time": whole.withColumn("report_dt", F.col("report_dt").cast("timestamp")), "date": whole.withColumn("report_dt", F.col("report_dt").cast("date"))}
    for name, frame in stored.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        read = scan_ledger(spark, f"{tmp_path}/{name}", span)
        asked = read.where(F.col("report_dt").between(*span))
        assert sorted(r["epk_id"] for r in asked.collect()) == [1, 2, 3]
        assert read.count() < whole.count(), name
        plan = asked._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert "(report_dt," in pushed, (name, pushed)
