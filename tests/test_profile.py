import datetime as dt

import pytest

from ledgercast.operators import profile as P
from ledgercast.operators.dataset import feature_dataset
from ledgercast.sources.profile import SuffixGroups, select_by_suffix, select_feature_sample

DAY = dt.date(2020, 6, 30)
DDL = "epk_id long, report_dt date, a_amt double, n_qty int, e_rate double, last_dt date, s_cd string, g_group int, note_txt string"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


@pytest.fixture()
def profile(spark):
    values = ["a", "a", "b", "b", "c", "c", "c", "c"]
    rows = [(i, DAY, float(i) if i else None, 3 if i % 2 else 4, None, None if i == 0 else dt.date(2020, 6, 1), v, None if i == 1 else 5, "t")
            for i, v in enumerate(values)]
    return frame(spark, rows)


def test_columns_by_suffix(profile):
    assert "note_txt" not in select_by_suffix(profile).columns
    assert select_feature_sample(profile, ["a_amt", "note_txt"]).columns == ["epk_id", "report_dt", "a_amt"]
    assert SuffixGroups().role("sd_gender_cd") == "categorical"


def test_means(profile):
    means = {r["feature"]: r["mean"] for r in P.numeric_means(profile).collect()}
    assert means == {"a_amt": 4.0, "n_qty": 3.5, "e_rate": 0.0}


def test_ties_are_told_apart(profile):
    codes = {r["value"]: r["code"] for r in P.category_frequency(profile).collect()}
    assert codes == {"a": 2 / 8, "b": 2.5 / 8, "c": 4 / 8, "other_value": -1.0}


def test_missing_category_counts_as_a_value(spark):
    rows = [(i, DAY, None, None, None, None, None if i < 3 else "x", None, None) for i in range(4)]
    codes = {r["value"]: r["code"] for r in P.category_frequency(frame(spark, rows)).collect()}
    assert codes == {"other_value": 0.75, "x": 0.25}


def test_too_many_values_remove_the_column(profile):
    assert P.category_frequency(profile, max_values=3).isEmpty()
    assert not P.category_frequency(profile, max_values=4).isEmpty()


def test_transform(spark, profile):
    params = P.fit_params(profile)
    unseen = frame(spark, [(1, DAY, None, None, None, None, "z", None, "t"), (2, DAY, 1.5, 7, None, dt.date(2020, 6, 20), "c", 8, "t")])
    first, second = P.profile_transform(unseen, params).orderBy("epk_id").collect()
    assert (first["a_amt"], first["a_amt_mean_na"]) == (0, 4)
    assert first["n_qty_mean_na"] == 3.5, "the mean of an integer column is not cut"
    assert (first["last_dt"], second["last_dt"]) == (0, 10)
    assert (first["s_cd"], second["s_cd"]) == (-1, 0.5)
    assert (first["g_group"], second["g_group"]) == (-9876, 8)


def test_transform_keeps_every_row_in_place(profile):
    plan = P.profile_transform(profile, P.fit_params(profile))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_values_with_quotes_survive_the_code_table(spark):
    rows = [(i, DAY, None, None, None, None, v, None, None) for i, v in enumerate(['say "x"', "back\\slash", "naïve €", 'say "x"'])]
    data = frame(spark, rows)
    params = P.fit_params(data)
    got = {r["epk_id"]: r["s_cd"] for r in P.profile_transform(data, params).collect()}
    assert got[0] == got[3] == 0.5 and got[1] != got[2]


def test_feature_groups():
    columns = ["epk_id", "report_dt", "a_amt", "a_amt_mean_na", "last_dt", "s_cd"]
    groups = P.profile_feature_groups(columns)
    assert groups == {"numeric": ["a_amt_mean_na", "a_amt"], "date": ["last_dt"], "categorical": ["s_cd"]}


def test_client_without_ledger_rows_stays_with_zeros(spark):
    left = spark.createDataFrame([(1, DAY, 2.0, "x"), (2, DAY, None, None)], "epk_id long, report_dt date, a double, s string")
    right = spark.createDataFrame([(1, DAY, 5.0)], "epk_id long, report_dt date, p double")
    rows = {r["epk_id"]: r for r in feature_dataset(left, right).collect()}
    assert rows[1]["p"] == 5 and (rows[2]["p"], rows[2]["a"], rows[2]["s"]) == (0, 0, None)
