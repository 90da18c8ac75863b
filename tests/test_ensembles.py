"""Ensembles as node tables against the fitted models, the staged search against one fit a point, samples by hash."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ledgercast.operators import ensembles as EN, models as M
from ledgercast.operators.cohort import bottom_rows, in_sample

FEATURES = ["f0", "f1", "f2"]
SEARCH = M.SearchSettings(depths=(2, 3), steps=(0.5, 0.1), iterations=(1, 3, 6))


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(400):
        f = [rng.random(), rng.gauss(0, 1), float(rng.randrange(5))]
        y = 3 * f[0] + f[1] * f[2] + rng.random()
        data.append((i, dt.date(2020, 6, 30), *f, y, float(y > 2)))
    frame = spark.createDataFrame(data, "epk_id long, report_dt date, f0 double, f1 double, f2 double, y double, flag double")
    return M.assemble_features(frame, FEATURES).cache()


def labelled(rows, label):
    return rows.withColumn(M.LABEL, F.col(label))


def fitted_models(rows):
    regression, classification = M.model_rich("A"), M.model_sale("A")
    boosted = M.boosted(regression, replace(SEARCH)).copy({}).setMaxIter(4).setMaxDepth(3).fit(labelled(rows, "y"))
    margin = M.boosted(classification, SEARCH).setMaxIter(4).setMaxDepth(2).fit(labelled(rows, "flag"))
    forest = RandomForestRegressor(featuresCol=M.VECTOR, labelCol="y", numTrees=5, maxDepth=4, seed=1).fit(rows)
    votes = RandomForestClassifier(featuresCol=M.VECTOR, labelCol="flag", numTrees=5, maxDepth=3, seed=1).fit(rows)
    return boosted, margin, forest, votes


def test_node_tables_score_as_the_models_do(rows):
    boosted, margin, forest, votes = fitted_models(rows)
    plain = rows.withColumn("x", vector_to_array(M.VECTOR))
    cases = [
        (boosted, False, EN.boosted_score(F.col("total")), F.col(boosted.getPredictionCol())),
        (margin, False, EN.boosted_score(F.col("total"), True), M.positive_probability(margin.getProbabilityCol())),
        (forest, False, EN.forest_score(F.col("total"), F.col("trees")), F.col("prediction")),
        (votes, True, EN.forest_score(F.col("total"), F.col("trees")), M.positive_probability("probability")),
    ]
    for model, share, score, own in cases:
        nodes = EN.saved_nodes(model, share)
        got = EN.tree_sums(plain, "x", nodes, ["epk_id"]).select("epk_id", score.alias("score"))
        want = model.transform(rows).select("epk_id", own.alias("own"))
        joined = got.join(want, "epk_id").agg(F.count("*").alias("n"), F.max(F.abs(F.col("score") - F.col("own"))).alias("d")).first()
        assert joined["n"] == 400 and joined["d"] < 1e-9


def test_prefixes_are_the_shorter_ensembles(rows):
    data = labelled(rows, "y")
    make = M.boosted(M.model_rich("A"), SEARCH).setMaxDepth(3)
    nodes = EN.saved_nodes(make.setMaxIter(6).fit(data))
    got = {r["epk_id"]: r["after"] for r in EN.prefix_scores(data, M.VECTOR, nodes, [1, 3, 6], ["epk_id"]).collect()}
    for k, n in enumerate((1, 3, 6)):
        short = make.copy().setMaxIter(n).fit(data)
        for r in short.transform(data).select("epk_id", short.getPredictionCol()).collect():
            assert abs(got[r[0]][k] - r[1]) < 1e-9


@pytest.mark.parametrize("spec, label", [(M.model_rich("A"), "y"), (M.model_total(loss="mae"), "y"), (M.model_sale("A"), "flag")])
def test_staged_search_finds_what_a_fit_for_every_point_finds(rows, spec, label):
    data = labelled(rows, label)
    fits = in_sample(SEARCH.train_share, SEARCH.seed)
    train, test = data.where(fits).cache(), data.where(~fits).cache()
    staged = M.search_scores(train, test, spec, SEARCH)
    score = f"{spec.predict}_raw" if spec.kind == "classification" else spec.predict
    evaluator = M._evaluator(spec, score)
    single = []
    for point in M.grid(SEARCH):
        model = M._with_params(M.boosted(spec, SEARCH), point).fit(train)
        single.append((point, evaluator.evaluate(model.transform(test))))
    assert [p for p, _ in staged] == [p for p, _ in single] and len(single) == 12
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(staged, single))
    larger = evaluator.isLargerBetter()
    model, params = M.gbt_search(data, spec, SEARCH)
    assert {k: params[k] for k in single[0][0]} == M.best_point(single, larger) and params["grid_points"] == 12
    assert model.getOrDefault("maxIter") == params["maxIter"]


def test_search_without_labels_to_compare_says_so(rows):
    flat = rows.withColumn(M.LABEL, F.when(F.col("epk_id") == 3, 1.0).otherwise(0.0))
    _, params = M.gbt_search(flat, M.model_rich("A"), replace(SEARCH, iterations=(1, 2)))
    assert params["grid_points"] == 1


@pytest.mark.parametrize("count", [0, 1, 2, 20, 200, 5000])
def test_bottom_rows_are_bounded_exact_and_repeatable(spark, count):
    frame = spark.range(count).select(F.col("id").alias("epk_id"), F.to_date(F.lit("2020-06-30")).alias("report_dt"))
    every = frame.select("epk_id", F.xxhash64(F.lit(7), "report_dt", "epk_id").alias("h")).orderBy("h").collect()
    for most, parts in ((1, 1), (20, 7), (20, 1), (199, 3)):
        got = sorted(r["epk_id"] for r in bottom_rows(frame.repartition(parts), most, 7).collect())
        assert got == sorted(r["epk_id"] for r in every[:most])


def test_rows_of_one_key_are_taken_together(spark):
    one = spark.range(10).select(F.lit(1).cast("long").alias("epk_id"), F.to_date(F.lit("2020-06-30")).alias("report_dt"))
    assert bottom_rows(one, 4, 7).count() == 0 and bottom_rows(one, 10, 7).count() == 10


def test_all_models_read_one_vector(rows):
    specs = [M.model_rich("A"), M.model_poor("B"), M.model_total()]
    frame = rows.drop(M.VECTOR)
    models = {}
    for spec, names in zip(specs, (["f2", "f0"], ["f1"], ["f0", "f1", "f2"])):
        vectors = M.assemble_features(frame, names).withColumn(M.LABEL, F.col("y"))
        final = M.boosted(spec, SEARCH).setMaxIter(2).setMaxDepth(2).fit(vectors)
        models[spec] = M.PipelineModel(stages=[M.VectorAssembler(inputCols=names, outputCol=M.VECTOR), final])
    models[M.model_sale("A")] = M.constant_model(M.model_sale("A"), 0.25)
    together = M.predict_all(frame, models, ["epk_id"])
    plan = together._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS features_of_all_models") == 1 and together.columns == ["epk_id", *[s.score for s in models]]
    alone = frame
    for spec, model in models.items():
        alone = M.predict_one(alone, spec, model)
    assert together.exceptAll(alone.select(*together.columns)).isEmpty()
