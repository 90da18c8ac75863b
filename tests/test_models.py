import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgercast.operators import models as M
from ledgercast.plans import catalog, jobs as J
from ledgercast.sources.stages import model_load, model_save

FEATURES = ["f0", "f1", "f2"]
SMALL = M.SearchSettings(
    forest_trees=3, forest_depth=2, forest_rows=1.0, depths=(2,), steps=(0.1,), iterations=(2, 4),
    refit_depth=3, cutoff_features=2, keep_features=2,
)


@pytest.fixture(scope="module")
def dataset(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        f = [rng.random() for _ in FEATURES]
        now = 0.0 if i % 3 else 10.0 * f[0]
        ahead = 100 * f[0] if f[1] > 0.4 else 0.0
        flag = int(now == 0 and ahead != 0)
        rows.append((i, dt.date(2020, 6, 30), *f, now, ahead, flag, now, ahead, i % 5 == 4))
    return spark.createDataFrame(
        rows,
        "epk_id long, report_dt date, f0 double, f1 double, f2 double, `A_pl_-1` double, A_pl_target double, "
        "A_sales_pl_target int, `total_pl_-1` double, total_pl_target double, is_valid boolean",
    ).cache()


def test_regression_fit(dataset):
    fitted = M.fit_model(dataset, FEATURES, M.model_rich("A"), SMALL)
    assert fitted.features and set(fitted.features) <= set(FEATURES)
    assert fitted.params["maxIter"] in (2, 4)
    metrics = {(r["scope"], r["metric"]) for r in fitted.metrics.collect()}
    assert metrics == {(s, m) for s in ("all_features", "selected_features") for m in ("mae", "rmse", "sum")}
    scored = M.predict_one(dataset, fitted.spec, fitted.model)
    assert scored.count() == 300 and "A_rich_pl_predict" in scored.columns and "all_features" not in scored.columns


def test_classification_scores_are_probabilities(dataset):
    fitted = M.fit_model(dataset, FEATURES, M.model_sale("A"), SMALL)
    low, high = M.predict_one(dataset, fitted.spec, fitted.model).agg(
        F.min("A_sales_pl_predict_probability"), F.max("A_sales_pl_predict_probability")
    ).first()
    assert 0 <= low < high <= 1


def test_forest_family_and_refit_on_all(dataset):
    from dataclasses import replace

    forest = M.fit_model(dataset, FEATURES, M.model_rich("A", family="rf"), SMALL)
    assert forest.model.stages[1].getNumTrees == SMALL.forest_trees
    whole = M.fit_model(dataset, FEATURES, M.model_total(loss="mae"), replace(SMALL, refit_on_all=True))
    assert whole.model.stages[1].getOrDefault("lossType") == "absolute"


def test_fit_is_repeatable(dataset):
    runs = []
    for frame in (dataset, dataset):
        fitted = M.fit_model(frame, FEATURES, M.model_poor("A"), SMALL)
        scored = M.predict_one(dataset, fitted.spec, fitted.model)
        runs.append({r["epk_id"]: r["A_poor_pl_predict"] for r in scored.collect()})
    assert runs[0] == runs[1]


def test_nothing_to_learn_gives_a_constant(dataset, tmp_path):
    flat = dataset.withColumn("A_pl_target", F.lit(7.0)).withColumn("A_sales_pl_target", F.lit(0))
    for spec, value in ((M.model_rich("A"), 7.0), (M.model_sale("A"), 0.0)):
        fitted = M.fit_model(flat, FEATURES, spec, SMALL)
        model_save(fitted.model, str(tmp_path), spec.id)
        scored = M.predict_one(flat, spec, model_load(str(tmp_path), spec.id))
        assert {r[0] for r in scored.select(spec.score).distinct().collect()} == {value}
    empty = M.fit_model(flat.where("false"), FEATURES, M.model_total(), SMALL)
    assert empty.features == []


def importances(spark, values):
    return M.feature_importance_table(spark, [f"f{i:03d}" for i in range(len(values))], values)


def test_cutoff_keeps_at_least_one(spark):
    assert [r["feature"] for r in M.importance_cutoff(importances(spark, [1.0, 0.0])).collect()] == ["f000"]


def test_cutoff_moves_the_border(spark):
    even = importances(spark, [1 / 200] * 200)
    running = M.importance_cumsum(even)
    assert M.importance_border(running, 100) == 0.9, "too many below 0.95: down to the lowest border"
    steep = importances(spark, [0.5, 0.3, 0.1] + [0.1 / 50] * 50)
    assert M.importance_border(M.importance_cumsum(steep), 100) == 0.998, "too few: up to the highest"
    # 27 features lie below 0.95 (0.9 and 24 steps of 0.002), the 28th below 0.951, the 29th below 0.953
    assert M.importance_border(M.importance_cumsum(steep), 28) == 0.951
    assert M.importance_border(M.importance_cumsum(steep), 29) == 0.953


def test_model_list():
    specs = M.all_models(["A", "B"])
    assert len(specs) == 7 and len({s.id for s in specs}) == 7
    assert {s.score for s in specs} >= {"A_sales_pl_predict_probability", "AllProducts_total_pl_predict"}


def test_whole_job(spark, sf):
    trained, train, test = catalog._trained(spark, sf)
    features = J.model_features(train, catalog.PLAN, catalog.MODEL_DIMS)
    assert len(features) == len(set(features)) and set(features) <= set(train.columns)
    assert not [c for c in features if "target" in c or c in ("epk_id", "report_dt", "is_valid")]
    report = J.test_report(trained, test, catalog.MODEL_DIMS)
    found = {(r["product"], r["part"]) for r in report.select("product", "part").distinct().collect()}
    assert {("Card", "rich_regression_model"), ("Loan", "poor_classification_model"), ("all", "total_naive_year")} <= found
    scores = catalog.QUERIES["score_clients"](spark, sf)
    assert not [c for c in scores.columns if "target" in c]
    clients = catalog.fx.table(spark, sf, "customer").count()
    assert scores.count() == clients and scores.where("total_pl_predict is null").isEmpty()


def test_staged_rows_are_split_by_their_flag(spark, dataset):
    rows = J.staged_by_flag(dataset, J.stage_path(spark, "flagged"))
    assert rows.columns == dataset.columns and rows.schema["is_valid"].dataType == dataset.schema["is_valid"].dataType
    assert rows.exceptAll(dataset).isEmpty() and rows.count() == dataset.count()
    for valid, share in ((False, 240), (True, 60)):
        part = M.validation_rows(rows, valid)
        assert part.count() == share and "PartitionFilters: [isnotnull(valid_part" in part._jdf.queryExecution().toString()
    none = J.staged_by_flag(dataset.where("false"), J.stage_path(spark, "flagged"))
    assert none.columns == dataset.columns and none.isEmpty()


def test_models_read_rows_behind_their_filter(spark, sf):
    _, train, test = catalog._trained(spark, sf)
    for rows in (train, test):
        assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_selection_keeps_its_sample(dataset, monkeypatch):
    seen, forest = [], M.forest

    class Watched:
        def __init__(self, *a):
            self.inner = forest(*a)

        def fit(self, rows):
            seen.append(rows.storageLevel.useMemory)
            return self.inner.fit(rows)

    monkeypatch.setattr(M, "forest", Watched)
    assert M.rf_importance(dataset, FEATURES, M.model_total(), SMALL).count() == len(FEATURES)
    assert seen == [True]


@pytest.mark.parametrize("name", ["gbt_regression", "gbt_search", "rf_importance", "rf_model"])
def test_queries_do_the_whole_job(monkeypatch, name):
    class Asked(Exception):
        pass

    def asked(*given):
        raise Asked(given[-1])

    monkeypatch.setattr(catalog, "_trained", lambda spark, sf: (None, None, None))
    monkeypatch.setattr(J, "model_features", lambda *a: FEATURES)
    monkeypatch.setattr(M, "fit_model", asked)
    monkeypatch.setattr(M, "rf_importance", asked)
    with pytest.raises(Asked) as found:
        catalog.QUERIES[name](None, None)
    s, published = found.value.args[0], M.SearchSettings()
    assert M.grid(s) == M.grid(published) and len(M.grid(s)) == 27
    for size in ("forest_trees", "forest_depth", "refit_depth", "keep_features", "cutoff_features"):
        assert getattr(s, size) == getattr(published, size)
    assert s.sample_rows is None and s.forest_rows == 1.0, "all rows of the segment, and as many for every tree"


def test_no_bound_takes_all_rows(dataset):
    assert M.some_rows(dataset, None, 23) is dataset
    assert M.some_rows(dataset, 100, 23).count() == 100
