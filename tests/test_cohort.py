import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgercast.functions.bucket import client_bucket, positive_hash
from ledgercast.functions.calendar import month_end, month_end_offset, month_range
from ledgercast.operators import cohort as H
from ledgercast.plans import fixtures as fx
from ledgercast.plans.cohort_plan import Cell, CohortPlan, CohortSettings, ScoringSettings


def day(text):
    return dt.date.fromisoformat(text)


def test_month_end():
    assert month_end("2020-02-10") == day("2020-02-29")
    assert month_end("2020-01-31", 1) == day("2020-02-29")
    assert month_end("2020-12-31", 2) == day("2021-02-28")
    assert len(month_range("2019-11-30", "2020-02-29")) == 4


@pytest.mark.parametrize(
    "start, n, expected",
    [
        ("2020-06-30", 1, "2020-07-31"),
        ("2020-06-30", 0, "2020-06-30"),
        ("2020-06-15", 0, "2020-06-30"),
        ("2020-06-15", 1, "2020-06-30"),
        ("2020-06-15", 2, "2020-07-31"),
        ("2020-06-15", -1, "2020-05-31"),
        ("2020-03-31", -1, "2020-02-29"),
    ],
)
def test_month_end_offset(spark, start, n, expected):
    row = spark.range(1).select(month_end_offset(F.lit(day(start)), n).alias("d")).first()
    assert row["d"] == day(expected)


def test_default_training_plan():
    plan = CohortPlan.training(CohortSettings())
    saved = plan.to_dict()
    assert saved["report_dt_borders_list"] == [["2020-06-30", "2020-06-30"], ["2020-09-30", "2020-09-30"]]
    assert saved["epk_bins_borders_list"] == [[1, 10], [20, 20]]
    assert saved["train"]["epk_bins_borders_list"] == [[1, 10]]
    assert saved["test"]["epk_bins_borders_list"] == [[20, 20]]
    assert CohortPlan.from_dict(saved) == plan
    assert len(plan.months()) == 6 + 12 + 3


def test_train_months_own_their_buckets():
    plan = CohortPlan.training(CohortSettings(train_months=3, train_width=4, test_bucket=100))
    blocks = [set(range(c.bin_lo, c.bin_hi + 1)) for c in plan.only("train").cells]
    assert len(set.union(*blocks)) == sum(map(len, blocks)) == 12


def test_plan_rejects_shared_or_missing_buckets():
    with pytest.raises(ValueError):
        CohortPlan.training(CohortSettings(train_bucket=1, train_width=30, test_bucket=20))
    with pytest.raises(ValueError):
        CohortPlan.training(CohortSettings(test_bucket=300))


def test_scoring_plan_takes_every_client():
    plan = CohortPlan.scoring(ScoringSettings())
    assert (plan.buckets, plan.predict) == (1, 0)
    assert plan.window(plan.cells[0]) == (day("2020-04-30"), day("2020-09-30"))


def test_saved_scoring_plan_with_repeated_cells_gives_each_client_month_once(spark):
    part = {
        "count_predict_months": 0, "count_history_months": 6, "number_of_epk_bins": 1,
        "report_dt_borders_list": [["2020-09-30", "2020-09-30"]], "epk_bins_borders_list": [[0, 0]],
    }
    plan = CohortPlan.from_dict(part | {"train": part, "test": part})
    rows = spark.createDataFrame([(7, day("2020-09-30"))], "epk_id long, report_dt date")
    assert H.with_cohort_month(rows, plan).count() == 1
    assert H.cohort_filter_ledger(rows, plan).count() == 1


def test_cell_over_several_months(spark):
    plan = CohortPlan((Cell("all", 0, 0, day("2020-01-31"), day("2020-03-31")),), 1, 2, 1)
    rows = spark.createDataFrame([(7, day("2020-02-29"))], "epk_id long, report_dt date")
    found = {r["cohort_dt"]: r["offset"] for r in H.with_cohort_month(rows, plan).collect()}
    assert found == {day("2020-01-31"): 1, day("2020-02-29"): 0, day("2020-03-31"): -1}


def test_bucket_range_and_smallest_hash(spark):
    ids = spark.range(20_000).select(
        client_bucket(F.col("id"), 300).alias("a"), client_bucket(F.col("id"), 300, "md5").alias("b")
    )
    low_a, high_a, low_b, high_b = ids.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert (low_a, high_a, low_b, high_b) == (0, 299, 0, 299)
    assert spark.range(1).select(positive_hash(F.lit("x"))).first()[0] >= 0


def test_filters_do_not_depend_on_partitioning(spark, sf):
    profile = fx.raw_profile(spark, sf)
    whole = H.cohort_filter_profile(profile, fx.PLAN).count()
    assert whole == H.cohort_filter_profile(profile.repartition(7), fx.PLAN).count()
    sampled = H.sample_rows(profile, 0.3, 23).select("epk_id", "report_dt")
    again = H.sample_rows(profile.repartition(5), 0.3, 23).select("epk_id", "report_dt")
    assert sampled.exceptAll(again).isEmpty() and again.exceptAll(sampled).isEmpty()


def test_train_and_test_share_no_client(spark, sf):
    train, test = H.cohort_split(fx.raw_profile(spark, sf), fx.PLAN)
    assert train.select("epk_id").intersect(test.select("epk_id")).isEmpty()
    assert train.groupBy("epk_id").count().where("count > 1").isEmpty()


def test_month_range_reaches_the_scan(spark, sf, tmp_path):
    path = str(tmp_path / "ledger")
    fx.ledger(spark, sf).write.parquet(path)
    plan = H.cohort_filter_ledger(spark.read.parquet(path), fx.PLAN)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(report_dt" in scan and "LessThanOrEqual(report_dt" in scan
    assert "Exchange hashpartitioning" not in plan
