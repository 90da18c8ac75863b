"""Segment models on MLlib: feature selection, parameter search, refit, prediction.

Three models per product and one for the total, each on its own client segment. A fit assembles
its rows into (vector, label) once and keeps only that between the many passes of a search.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import product as combinations
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ledgercast.operators.cohort import bottom_rows, in_sample, validation_rows
from ledgercast.operators.ensembles import prefix_scores, saved_nodes
from ledgercast.operators.evaluate import as_long, classification_metrics, regression_metrics
from ledgercast.operators.targets import segment, target
from ledgercast.session import shared_folder
from ledgercast.sources.local_table import local_table

VECTOR = "all_features"
UNION = "features_of_all_models"
LABEL = "label"
TOTAL = "AllProducts"


@dataclass(frozen=True)
class ModelSpec:
    """What a model learns, from which clients, and where its score goes."""

    name: str
    product: str
    segment: str
    target: str
    predict: str
    kind: str
    loss: str | None = "mse"
    family: str = "gb"

    @property
    def id(self) -> str:
        return f"{self.product}_{self.name}"

    @property
    def score(self) -> str:
        return f"{self.predict}_probability" if self.kind == "classification" else self.predict


def model_rich(product: str, **options) -> ModelSpec:
    """Year-ahead P&L of clients who have the product."""
    return ModelSpec(
        "rich_regression", product, "rich", target(product), f"{product}_rich_pl_predict", "regression", **options
    )


def model_poor(product: str, **options) -> ModelSpec:
    """Year-ahead P&L of clients who will take the product up."""
    return ModelSpec(
        "poor_regression", product, "poor_sold", target(product), f"{product}_poor_pl_predict", "regression", **options
    )


def model_sale(product: str, **options) -> ModelSpec:
    """Chance that a client without the product takes it up."""
    return ModelSpec(
        "poor_classification", product, "poor", f"{product}_sales_pl_target", f"{product}_sales_pl_predict",
        "classification", loss=None, **options,
    )


def model_total(**options) -> ModelSpec:
    """Year-ahead total of all clients in one model."""
    return ModelSpec("total_regression", TOTAL, "all", "total_pl_target", f"{TOTAL}_total_pl_predict", "regression", **options)


def all_models(products: list[str], **options) -> list[ModelSpec]:
    specs = [make(p, **options) for p in products for make in (model_rich, model_poor, model_sale)]
    return specs + [model_total(**options)]


@dataclass(frozen=True)
class SearchSettings:
    """Sizes of the selection, the search and the refit. The defaults are fixed values.

    ``sample_rows`` bounds the rows of a segment that features and parameters are chosen on; None takes all.
    """

    sample_rows: int | None = 200_000
    selection_seed: int = 23
    search_seed: int = 46
    keep_features: int = 300
    forest_trees: int = 100
    forest_depth: int = 5
    forest_features: str = "0.2"
    forest_rows: float = 0.1
    depths: tuple[int, ...] = (3, 6, 9)
    steps: tuple[float, ...] = (0.1, 0.01, 0.001)
    iterations: tuple[int, ...] = (10, 50, 120)
    train_share: float = 0.7
    cutoff_features: int = 100
    refit_depth: int = 25
    refit_on_all: bool = False
    seed: int = 23
    parallel_fits: int = 4


@dataclass
class FittedModel:
    spec: ModelSpec
    model: PipelineModel
    features: list[str]
    metrics: DataFrame
    importances: DataFrame
    params: dict = field(default_factory=dict)


# -- pieces --------------------------------------------------------------------------------------


def assemble_features(df: DataFrame, features: list[str], output: str = VECTOR) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=output).transform(df)


def positive_probability(vector: str | Column) -> Column:
    """Second element of a class probability vector."""
    return vector_to_array(F.col(f"`{vector}`") if isinstance(vector, str) else vector).getItem(1)


def feature_importance_table(spark: SparkSession, features: list[str], importances: list[float]) -> DataFrame:
    """``(feature, importance)``; as many rows as the model has features."""
    rows = [(name, float(value)) for name, value in zip(features, importances)]
    return local_table(spark, rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_features(importances: DataFrame, count: int = 300) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(count)


def importance_cumsum(importances: DataFrame) -> DataFrame:
    """Running importance from the most important feature down.

    One row per model feature: the table is as long as the dataset is wide.
    """
    order = Window.orderBy(F.desc("importance"), "feature").rowsBetween(Window.unboundedPreceding, 0)
    return importances.withColumn("running", F.sum("importance").over(order))


# Where the importance border starts, how far it may move, and in which steps.
BORDER_START, BORDER_LOW, BORDER_HIGH, BORDER_STEP = 0.95, 0.9, 0.998, 0.001


def importance_border(running: DataFrame, wanted: int = 100) -> float:
    """Border on the running importance that leaves about ``wanted`` features."""
    steps_up = round((BORDER_HIGH - BORDER_START) / BORDER_STEP)
    steps_down = round((BORDER_START - BORDER_LOW) / BORDER_STEP)
    borders = [round(BORDER_START + k * BORDER_STEP, 3) for k in range(-steps_down, steps_up + 1)]
    row = running.agg(*[F.count_if(F.col("running") < b).alias(str(i)) for i, b in enumerate(borders)]).first()
    below = dict(zip(borders, row))
    if below[BORDER_START] < wanted:
        upward = [b for b in borders if b >= BORDER_START]
        return next((b for b in upward if below[b] >= wanted), upward[-1])
    downward = [b for b in reversed(borders) if b <= BORDER_START]
    return next((b for b in downward if below[b] < wanted), downward[-1])


def importance_cutoff(importances: DataFrame, wanted: int = 100) -> DataFrame:
    """Features below the border; the most important one always stays."""
    running = importance_cumsum(importances)
    border = importance_border(running, wanted)
    first = F.col("running") == F.col("importance")
    return running.where((F.col("running") < border) | first)


# -- estimators ----------------------------------------------------------------------------------


def _named(estimator, spec: ModelSpec):
    """Set the columns an estimator reads and writes."""
    estimator.setFeaturesCol(VECTOR).setLabelCol(LABEL).setPredictionCol(spec.predict)
    if spec.kind == "classification":
        estimator.setRawPredictionCol(f"{spec.predict}_raw")
        estimator.setProbabilityCol(f"{spec.predict}_probability")
    return estimator


def forest(spec: ModelSpec, s: SearchSettings, depth: int, features: str, rows: float):
    make = RandomForestClassifier if spec.kind == "classification" else RandomForestRegressor
    estimator = make(
        seed=s.seed, maxDepth=depth, numTrees=s.forest_trees,
        featureSubsetStrategy=features, subsamplingRate=rows, cacheNodeIds=False,
    )
    return _named(estimator, spec)


def boosted(spec: ModelSpec, s: SearchSettings):
    if spec.kind == "classification":
        return _named(GBTClassifier(seed=s.seed), spec)
    loss = "absolute" if spec.loss == "mae" else "squared"
    return _named(GBTRegressor(seed=s.seed, lossType=loss), spec)


def grid(s: SearchSettings) -> list[dict]:
    """All points of the search, in the order that decides ties."""
    return [{"maxDepth": d, "stepSize": step, "maxIter": n} for d, step, n in combinations(s.depths, s.steps, s.iterations)]


def _evaluator(spec: ModelSpec, score: str):
    if spec.kind == "classification":
        return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=LABEL, metricName="areaUnderPR", numBins=0)
    name = "mae" if spec.loss == "mae" else "rmse"
    return RegressionEvaluator(labelCol=LABEL, predictionCol=score, metricName=name)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep rows between passes, on memory and disk; lost blocks are computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _vectors(df: DataFrame, features: list[str], spec: ModelSpec) -> DataFrame:
    return assemble_features(df, features).select(
        "epk_id", "report_dt", VECTOR, F.col(f"`{spec.target}`").cast("double").alias(LABEL)
    )


# -- fit -----------------------------------------------------------------------------------------


def some_rows(train: DataFrame, most: int | None, seed: int) -> DataFrame:
    """The sample to fit on: the ``most`` rows with the smallest hashes, all rows of a segment that has no more."""
    return train if most is None else bottom_rows(train, most, seed)


def rf_importance(train: DataFrame, features: list[str], spec: ModelSpec, s: SearchSettings) -> DataFrame:
    """Importance of every feature in a shallow forest on a sample."""
    with kept(_vectors(some_rows(train, s.sample_rows, s.selection_seed), features, spec)) as rows:
        fitted = forest(spec, s, s.forest_depth, s.forest_features, s.forest_rows).fit(rows)
    return feature_importance_table(train.sparkSession, features, fitted.featureImportances.toArray())


def search_scores(train: DataFrame, test: DataFrame, spec: ModelSpec, s: SearchSettings) -> list[tuple[dict, float]]:
    """Every point of the grid with its measure on ``test``.

    A boosted ensemble's first rounds are the ensemble of fewer rounds, so one fit answers all points
    that differ in their rounds alone: its nodes are read as a table and summed up to each of them.
    The fits are independent, so ``parallel_fits`` of them run at a time.
    """
    estimator = boosted(spec, s)
    rounds = sorted(set(s.iterations))
    stems = [
        {estimator.maxDepth: d, estimator.stepSize: step, estimator.maxIter: rounds[-1]} for d, step in combinations(s.depths, s.steps)
    ]
    fits = estimator.fitMultiple(train, stems)

    def measured(_) -> dict[tuple, float]:
        i, model = next(fits)
        with kept(prefix_scores(test, VECTOR, saved_nodes(model), rounds, [LABEL])) as scored:
            values = [_evaluator(spec, "score").evaluate(scored.select(LABEL, F.col("after")[k].alias("score"))) for k in range(len(rounds))]
        return {(stems[i][estimator.maxDepth], stems[i][estimator.stepSize], n): value for n, value in zip(rounds, values)}

    with ThreadPool(min(s.parallel_fits, len(stems))) as pool:
        parts = pool.map(inheritable_thread_target(train.sparkSession)(measured), range(len(stems)), chunksize=1)
    found = {point: value for part in parts for point, value in part.items()}
    return [(point, found[point["maxDepth"], point["stepSize"], point["maxIter"]]) for point in grid(s)]


def best_point(scores: list[tuple[dict, float]], larger: bool) -> dict:
    """The best of the grid's points; equal measures, up to rounding, go to the first."""
    sign = -1 if larger else 1
    return min(scores, key=lambda pair: sign * float(f"{pair[1]:.10g}"))[0]


def gbt_search(rows: DataFrame, spec: ModelSpec, s: SearchSettings):
    """Best boosted model over the grid, fitted on all given rows, with its parameters.

    ``grid_points`` among them tells how many points were measured: one, unmeasured, where a fold of the
    rows has a single label.
    """
    points = grid(s)
    best, measured = points[0], 1
    if len(points) > 1:
        fits = in_sample(s.train_share, s.seed)
        train, test = rows.where(fits), rows.where(~fits)
        labels = F.count_distinct(LABEL)
        if train.agg(labels).first()[0] > 1 and test.agg(labels).first()[0] > 1:
            best = best_point(search_scores(train, test, spec, s), _evaluator(spec, "score").isLargerBetter())
            measured = len(points)
    return _with_params(boosted(spec, s), best).fit(rows), {**best, "grid_points": measured}


def _with_params(estimator, params: dict):
    known = {estimator.getParam(name): value for name, value in params.items() if estimator.hasParam(name)}
    return estimator.copy(known)


def model_metrics(predicted: DataFrame, spec: ModelSpec, scope: str) -> DataFrame:
    """Long metrics of one model on labelled predictions, as a small local table."""
    part = F.lit(spec.name).alias("part")
    if spec.kind == "classification":
        scores = predicted.select(
            F.lit(spec.product).alias("product"),
            positive_probability(f"{spec.predict}_probability").alias("score"),
            F.col(LABEL).cast("long").alias("target"),
        )
        with kept(scores) as rows:
            metrics = classification_metrics(rows).withColumn("part", part)
            return _local_copy(as_long(metrics, scope, ["roc_auc", "pr_auc", "sum"]))
    rows = predicted.select(
        F.lit(spec.product).alias("product"), part, F.col(LABEL).alias("target"), F.col(spec.predict).alias("predict")
    )
    return _local_copy(as_long(regression_metrics(rows, ["product", "part"]), scope, ["mae", "rmse", "sum"]))


def _local_copy(metrics: DataFrame) -> DataFrame:
    """A few metric rows, computed once."""
    rows = [tuple(r) for r in metrics.collect()]
    return local_table(metrics.sparkSession, rows, metrics.schema)


def constant_model(spec: ModelSpec, value: float) -> PipelineModel:
    """For a segment with nothing to learn from: the same score for every client."""
    statement = f"SELECT *, CAST({value!r} AS DOUBLE) AS `{spec.score}` FROM __THIS__"
    return PipelineModel(stages=[SQLTransformer(statement=statement)])


def fit_model(dataset: DataFrame, features: list[str], spec: ModelSpec, s: SearchSettings = SearchSettings()) -> FittedModel:
    """Select features with a forest, search parameters on a sample, refit on the chosen features.

    ``dataset`` carries ``is_valid``. Metrics before (``all_features``) and after selection
    (``selected_features``) are taken on validation rows, which the refit leaves out unless
    ``refit_on_all``.
    """
    spark = dataset.sparkSession
    shared_folder(spark)
    rows = segment(dataset, spec.segment, None if spec.product == TOTAL else spec.product)
    train, valid = validation_rows(rows, False), validation_rows(rows, True)
    label = F.col(f"`{spec.target}`").cast("double")
    low, high, mean = train.agg(F.min(label), F.max(label), F.avg(label)).first()
    if low is None or low == high:
        empty = "scope string, product string, part string, metric string, value double"
        return FittedModel(
            spec, constant_model(spec, mean or 0.0), [], local_table(spark, [], empty),
            feature_importance_table(spark, [], []),
        )

    wide = rf_importance(train, features, spec, s)
    chosen = [r["feature"] for r in top_features(wide, s.keep_features).collect()]

    sample = some_rows(train, s.sample_rows, s.search_seed)
    with kept(_vectors(sample, chosen, spec)) as searched:
        if spec.family == "gb":
            first, params = gbt_search(searched, spec, s)
        else:
            first, params = forest(spec, s, s.forest_depth, "0.8", s.forest_rows).fit(searched), {}
    before = model_metrics(first.transform(_vectors(valid, chosen, spec)), spec, "all_features")

    importances = feature_importance_table(spark, chosen, first.featureImportances.toArray())
    short = [r["feature"] for r in importance_cutoff(importances, s.cutoff_features).orderBy(F.desc("importance"), "feature").collect()]

    if spec.family == "gb":
        estimator = _with_params(boosted(spec, s), params)
    else:
        estimator = forest(spec, s, s.refit_depth, "0.9", s.forest_rows)
    with kept(_vectors(rows if s.refit_on_all and spec.family == "gb" else train, short, spec)) as refit_rows:
        final = estimator.fit(refit_rows)
    after = model_metrics(final.transform(_vectors(valid, short, spec)), spec, "selected_features")
    table = feature_importance_table(spark, short, final.featureImportances.toArray())
    pipeline = PipelineModel(stages=[VectorAssembler(inputCols=short, outputCol=VECTOR), final])
    return FittedModel(spec, pipeline, short, before.union(after), table, params)


class FitsFailed(RuntimeError):
    """Some fits of a run failed; the others are finished, and in the run's ledger if it has one."""

    def __init__(self, errors: dict[str, Exception], finished: list[FittedModel]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.errors, self.finished = errors, finished


def fit_models(
    dataset: DataFrame, features: list[str], specs: list[ModelSpec], s: SearchSettings = SearchSettings(), ledger=None
) -> list[FittedModel]:
    """Fit independent models, a few at a time: a small segment alone leaves a cluster idle.

    With a ledger, fits that an earlier run finished are read, and every new one is committed as soon
    as it is made. A fit that fails does not stop the others; all failures are raised together at the end.
    """

    def made(spec: ModelSpec) -> FittedModel | Exception:
        try:
            known = ledger.find(spec, features, s) if ledger else None
            if known:
                return known
            fitted = fit_model(dataset, features, spec, s)
            if ledger:
                ledger.commit(fitted, features, s)
            return fitted
        except Exception as error:  # reported with the others below
            return error

    with ThreadPool(min(s.parallel_fits, len(specs))) as pool:
        results = pool.map(inheritable_thread_target(dataset.sparkSession)(made), specs, chunksize=1)
    errors = {spec.id: r for spec, r in zip(specs, results) if isinstance(r, Exception)}
    finished = [r for r in results if not isinstance(r, Exception)]
    if errors:
        raise FitsFailed(errors, finished)
    return finished


# -- predict -------------------------------------------------------------------------------------


def predict_one(dataset: DataFrame, spec: ModelSpec, model: PipelineModel) -> DataFrame:
    """Add the score of one model as a plain DOUBLE column."""
    scored = model.transform(dataset).drop(VECTOR)
    if spec.kind == "classification":
        if not isinstance(scored.schema[spec.score].dataType, T.DoubleType):
            scored = scored.withColumn(spec.score, positive_probability(spec.score))
        scored = scored.drop(spec.predict, f"{spec.predict}_raw")
    return scored


def predict_all(dataset: DataFrame, models: dict[ModelSpec, PipelineModel], keep: list[str]) -> DataFrame:
    """Scores of every model beside the kept columns; map-side throughout.

    The features of all models are assembled once; each model reads its own slice of that vector.
    """
    assembled = {spec: m.stages[0].getInputCols() for spec, m in models.items() if isinstance(m.stages[0], VectorAssembler)}
    union = list(dict.fromkeys(c for columns in assembled.values() for c in columns))
    place = {c: i for i, c in enumerate(union)}
    out = assemble_features(dataset, union, UNION) if union else dataset
    for spec, model in models.items():
        if spec in assembled:
            slicer = VectorSlicer(inputCol=UNION, outputCol=VECTOR, indices=[place[c] for c in assembled[spec]])
            model = PipelineModel(stages=[slicer, *model.stages[1:]])
        out = predict_one(out, spec, model)
    return out.select(*[f"`{c}`" for c in keep], *[f"`{spec.score}`" for spec in models])
