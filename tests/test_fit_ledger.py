"""Training that survives: finished fits are kept one by one and read by the next run."""

import datetime as dt
import random
from dataclasses import replace

import pytest

from ledgercast.operators import models as M
from ledgercast.plans.fit_ledger import FitLedger, read_specs, spec_table
from ledgercast.session import stage_path

FEATURES = ["f0", "f1"]
SMALL = M.SearchSettings(
    forest_trees=3, forest_depth=2, forest_rows=1.0, depths=(2,), steps=(0.1,), iterations=(1, 2), refit_depth=3,
    cutoff_features=2, keep_features=2,
)
SPECS = [M.model_rich("A"), M.model_poor("A"), M.model_sale("A", family="rf"), M.model_total(loss="mae")]


@pytest.fixture(scope="module")
def dataset(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        f = [rng.random(), rng.random()]
        now, ahead = (0.0 if i % 3 else 5 * f[0]), (50 * f[0] if f[1] > 0.4 else 0.0)
        rows.append((i, dt.date(2020, 6, 30), *f, now, ahead, int(now == 0 and ahead != 0), now, ahead, i % 5 == 4))
    return spark.createDataFrame(
        rows,
        "epk_id long, report_dt date, f0 double, f1 double, `A_pl_-1` double, A_pl_target double, A_sales_pl_target int, "
        "`total_pl_-1` double, total_pl_target double, is_valid boolean",
    ).cache()


def scores(dataset, fitted):
    scored = M.predict_one(dataset, fitted.spec, fitted.model)
    return {r[0]: r[1] for r in scored.select("epk_id", fitted.spec.score).collect()}


def test_a_second_run_fits_only_what_is_missing(spark, dataset, monkeypatch):
    ledger = FitLedger(spark, stage_path(spark, "fits"))
    assert ledger.records() == []
    real, asked = M.fit_model, []

    def breaking(data, features, spec, settings):
        asked.append(spec.id)
        if spec.name == "poor_regression":
            raise ValueError("no memory left")
        return real(data, features, spec, settings)

    monkeypatch.setattr(M, "fit_model", breaking)
    with pytest.raises(M.FitsFailed, match="A_poor_regression: no memory left") as failure:
        M.fit_models(dataset, FEATURES, SPECS, SMALL, ledger)
    assert list(failure.value.errors) == ["A_poor_regression"] and len(failure.value.finished) == 3
    assert sorted(asked) == sorted(s.id for s in SPECS) and len(ledger.records()) == 3
    # A fit that was cut off before its record counts for nothing.
    real(dataset, FEATURES, SPECS[1], SMALL).model.write().save(f"{ledger.path}/{SPECS[1].id}/cut/model")

    asked.clear()
    monkeypatch.setattr(M, "fit_model", lambda *a: asked.append(a[2].id) or real(*a))
    fitted = M.fit_models(dataset, FEATURES, SPECS, SMALL, ledger)
    assert asked == ["A_poor_regression"] and [f.spec for f in fitted] == SPECS
    for whole, part in zip(M.fit_models(dataset, FEATURES, SPECS, SMALL), fitted):
        assert scores(dataset, whole) == scores(dataset, part) and whole.params == part.params and whole.features == part.features
        assert sorted(whole.metrics.collect()) == sorted(part.metrics.collect())
        assert sorted(whole.importances.collect()) == sorted(part.importances.collect())


def test_other_settings_are_another_fit(spark, dataset):
    ledger = FitLedger(spark, stage_path(spark, "fits"))
    M.fit_models(dataset, FEATURES, SPECS[:1], SMALL, ledger)
    assert ledger.find(SPECS[0], FEATURES, SMALL) is not None
    assert ledger.find(SPECS[0], FEATURES, replace(SMALL, seed=1)) is None
    assert ledger.find(SPECS[0], FEATURES[:1], SMALL) is None and ledger.find(SPECS[3], FEATURES, SMALL) is None


def test_specifications_are_read_as_they_were(spark):
    assert read_specs(spec_table(spark, SPECS)) == SPECS
