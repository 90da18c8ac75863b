"""Queries against their SQL at the smallest scale; ``tests/check.py`` runs all of them."""

import pytest

import __spark_entry__ as entry_point
from check import connect, difference

CHECKED = [
    "scan_ledger", "cohort_plan", "month_end_shift", "cohort_filter_ledger", "category_frequency",
    "product_total_leads", "delta_relative", "pnl_dataset", "calibration_fit_observed", "classification_metrics_tied",
    "eval_product_total", "eval_total", "ensemble_scores", "profile_feature_groups", "profile_transform",
    "feature_dataset", "scoring_features",
]


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, duck, name):
    assert difference(entry_point.queries()[name](spark, sf), duck, entry_point.oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_shares_read_their_table_once(spark, sf):
    from ledgercast.plans import catalog

    assert all("feature-sums" in path for path in catalog._code_importances(spark, sf).inputFiles())
