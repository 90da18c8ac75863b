"""Whole jobs: features, training, evaluation and scoring.

Stages whose result is read more than once are written to shared storage and read back; the rest
stays one lazy plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgercast.dimensions import Dimensions
from ledgercast.operators.calibration import BINS, CalibrationBin, calibration_fit, load_calibration
from ledgercast.operators.cohort import cohort_filter_profile, cohort_split, validation_flag, validation_rows
from ledgercast.operators.combine import combine
from ledgercast.operators.dataset import profile_with_cells
from ledgercast.operators.evaluate import evaluate, sale_scores
from ledgercast.operators.ledger import client_cells, cohort_rows, feature_names, features_of_cells, keep_sample
from ledgercast.operators.models import (
    FittedModel,
    ModelSpec,
    SearchSettings,
    all_models,
    fit_models,
    predict_all,
)
from ledgercast.operators.profile import ProfileParams, fit_params, profile_feature_groups, profile_transform
from ledgercast.operators.targets import dataset_of_cells, drop_targets, now, scoring_total_naive, target
from ledgercast.plans.cohort_plan import CohortPlan
from ledgercast.plans.fit_ledger import FitLedger, read_specs, spec_table
from ledgercast.session import stage_path
from ledgercast.sources.local_table import local_table
from ledgercast.sources.profile import SuffixGroups, select_by_suffix, select_feature_sample
from ledgercast.sources.stages import model_load, model_save, score_sink, stage_read, stage_write, staged

KEYS = ["epk_id", "report_dt"]
VALID_FOLDER = "valid_part"
CALIBRATION = "product string, bin int, lo double, hi double, coef double"


@dataclass
class Trained:
    """Everything scoring needs from training."""

    params: ProfileParams
    models: dict[ModelSpec, PipelineModel]
    calibration: dict[str, list[CalibrationBin]]
    fitted: list[FittedModel] = field(default_factory=list)

    def save_models(self, path: str) -> list[str]:
        return [model_save(model, path, spec.id) for spec, model in self.models.items()]

    @staticmethod
    def load_models(path: str, specs: list[ModelSpec]) -> dict[ModelSpec, PipelineModel]:
        return {spec: model_load(path, spec.id) for spec in specs}

    def save(self, spark: SparkSession, path: str) -> None:
        """Models with their specifications, encoding, calibration and, after a fit, importances, validation metrics
        and chosen parameters, under one project folder."""
        self.save_models(f"{path}/models")
        stage_write(spec_table(spark, list(self.models)), f"{path}/model_specs")
        means = list(self.params.means.items())
        codes = [(f, value, code) for f, table in self.params.codes.items() for value, code in table.items()]
        bins = [(p, i, b.lo, b.hi, b.coef) for p, table in self.calibration.items() for i, b in enumerate(table)]
        stage_write(local_table(spark, means, "feature string, mean double"), f"{path}/profile_means")
        stage_write(local_table(spark, codes, "feature string, value string, code double"), f"{path}/profile_codes")
        stage_write(local_table(spark, bins, CALIBRATION), f"{path}/calibration")
        if self.fitted:
            tables = [f.importances.withColumn("model", F.lit(f.spec.id)) for f in self.fitted]
            stage_write(reduce(DataFrame.union, tables), f"{path}/feature_importances")
            stage_write(reduce(DataFrame.union, [f.metrics for f in self.fitted]).coalesce(1), f"{path}/validation_metrics")
            params = [(f.spec.id, name, float(value)) for f in self.fitted for name, value in f.params.items()]
            stage_write(local_table(spark, params, "model string, name string, value double"), f"{path}/chosen_parameters")

    @classmethod
    def load(cls, spark: SparkSession, path: str, dims: Dimensions) -> Trained:
        """What ``save`` wrote. Families and losses come from the saved specifications."""
        means = stage_read(spark, f"{path}/profile_means")
        codes = stage_read(spark, f"{path}/profile_codes")
        calibration = load_calibration(stage_read(spark, f"{path}/calibration"), dims.product_names)
        params = ProfileParams.load(means, codes, codes.select("feature").distinct().count())
        specs = read_specs(stage_read(spark, f"{path}/model_specs"))
        return cls(params, cls.load_models(f"{path}/models", specs), calibration)


def cohort_profile(
    profile: DataFrame,
    plan: CohortPlan,
    sample: DataFrame | None = None,
    wanted: list[str] | None = None,
    groups: SuffixGroups = SuffixGroups(),
) -> DataFrame:
    """Typed profile columns of the plan's client-months, optionally of sampled clients only."""
    typed = select_by_suffix(profile, groups) if wanted is None else select_feature_sample(profile, wanted, groups)
    rows = cohort_filter_profile(typed, plan)
    return rows if sample is None else keep_sample(rows, sample)


def train_params(profile: DataFrame, plan: CohortPlan, groups: SuffixGroups = SuffixGroups()) -> ProfileParams:
    """Encoding fitted on the train rows of a cohort profile."""
    return fit_params(cohort_filter_profile(profile, plan.only("train")), groups)


def full_dataset(
    profile: DataFrame,
    ledger: DataFrame,
    plan: CohortPlan,
    dims: Dimensions,
    params: ProfileParams,
    groups: SuffixGroups = SuffixGroups(),
    sample: DataFrame | None = None,
) -> DataFrame:
    """Encoded profile beside the ledger dataset, one row per client-month of the plan."""
    cells = client_cells(cohort_rows(ledger, plan, dims), plan, dims, sample=sample)
    return dataset_of_cells(profile_with_cells(profile_transform(profile, params, groups), cells), plan, dims)


def model_features(
    dataset: DataFrame, plan: CohortPlan, dims: Dimensions, groups: SuffixGroups = SuffixGroups()
) -> list[str]:
    """Profile features by role, ledger features, and the report-month total."""
    ledger_columns = feature_names(plan, dims)
    others = set(ledger_columns) | set(outcome_columns(dataset, dims))
    roles = profile_feature_groups([c for c in dataset.columns if c not in others], groups)
    return roles["numeric"] + roles["date"] + roles["categorical"] + ledger_columns + ["total_pl_-1"]


def outcome_columns(dataset: DataFrame, dims: Dimensions) -> list[str]:
    """Targets, flags and naive forecasts of the dataset; in scoring only the naive ones exist."""
    products = dims.product_names
    wanted = [target(p) for p in products] + [f"{p}_sales_pl_target" for p in products] + [now(p) for p in products]
    wanted += [target("total"), now("total")]
    return [c for c in wanted if c in dataset.columns]


def predict_outcomes(dataset: DataFrame, models: dict[ModelSpec, PipelineModel], dims: Dimensions) -> DataFrame:
    """Keys, outcomes and all scores."""
    return predict_all(dataset, models, KEYS + outcome_columns(dataset, dims))


def calibrate(
    train: DataFrame, models: dict[ModelSpec, PipelineModel], dims: Dimensions, mode: str = "contiguous"
) -> DataFrame:
    """Calibration table from the validation rows of the train set."""
    sales = {spec: model for spec, model in models.items() if spec.kind == "classification"}
    valid = validation_rows(train)
    keep = [c for p in dims.product_names for c in (f"{p}_pl_-1", f"{p}_sales_pl_target")]
    scored = predict_all(valid, sales, KEYS + keep)
    scored = staged(scored, stage_path(train.sparkSession, "calibration-scores"))
    return calibration_fit(sale_scores(scored, dims.product_names), BINS, mode)


def train(
    profile: DataFrame,
    ledger: DataFrame,
    plan: CohortPlan,
    dims: Dimensions,
    settings: SearchSettings = SearchSettings(),
    groups: SuffixGroups = SuffixGroups(),
    sample: DataFrame | None = None,
    wanted: list[str] | None = None,
    calibration_mode: str = "contiguous",
    fits: FitLedger | None = None,
    **model_options,
) -> tuple[Trained, DataFrame, DataFrame]:
    """Fit everything; also returns the staged train and test datasets.

    Every model reads the train rows many times, so they are staged once more behind their cohort filter,
    training and validation rows in folders of their own; so are the test rows. With ``fits`` every model is kept as soon as it is fitted, and a run after a failure fits only what is missing.
    """
    spark = profile.sparkSession
    chosen = cohort_profile(profile, plan, sample, wanted, groups)
    selected = staged(chosen, stage_path(spark, "profile"), "report_dt")
    params = train_params(selected, plan, groups)
    dataset = full_dataset(selected, ledger, plan, dims, params, groups, sample)
    dataset = staged(dataset, stage_path(spark, "dataset"), "report_dt")
    train_rows, test_rows = cohort_split(dataset, plan)
    train_rows = staged_by_flag(validation_flag(train_rows, plan.hash_kind), stage_path(spark, "train-rows"))
    test_rows = staged(test_rows, stage_path(spark, "test-rows"))
    features = model_features(dataset, plan, dims, groups)
    fitted = fit_models(train_rows, features, all_models(dims.product_names, **model_options), settings, fits)
    models = {f.spec: f.model for f in fitted}
    table = calibrate(train_rows, models, dims, calibration_mode)
    return Trained(params, models, load_calibration(table, dims.product_names), fitted), train_rows, test_rows


def staged_by_flag(flagged: DataFrame, path: str) -> DataFrame:
    """Rows staged by ``is_valid``: a read of one kind skips the files of the other."""
    split = flagged.withColumn(VALID_FOLDER, F.col("is_valid").cast("int")).drop("is_valid")
    stage_write(split, path, VALID_FOLDER)
    rows = flagged.sparkSession.read.schema(split.schema).parquet(path).withColumn("is_valid", F.col(VALID_FOLDER) == 1)
    return rows.select(*[f"`{c}`" for c in flagged.columns])


def test_report(trained: Trained, test_rows: DataFrame, dims: Dimensions) -> DataFrame:
    """Test metrics of the combined scores with the validation metrics of each model."""
    scores = combine(predict_outcomes(test_rows, trained.models, dims), trained.calibration, dims.product_names)
    combined = staged(scores, stage_path(test_rows.sparkSession, "test-scores"))
    report = evaluate(combined, dims.product_names)
    for fitted in trained.fitted:
        report = report.union(fitted.metrics)
    return report


def scoring_features(
    profile: DataFrame,
    ledger: DataFrame,
    plan: CohortPlan,
    dims: Dimensions,
    params: ProfileParams,
    groups: SuffixGroups = SuffixGroups(),
    sample: DataFrame | None = None,
    wanted: list[str] | None = None,
) -> DataFrame:
    """Features of the scoring month with the encoding of training; no months ahead."""
    encoded = profile_transform(cohort_profile(profile, plan, sample, wanted, groups), params, groups)
    cells = client_cells(cohort_rows(ledger, plan, dims), plan, dims, True, sample)
    return scoring_total_naive(features_of_cells(profile_with_cells(encoded, cells), plan, dims), dims.product_names)


def score_clients(
    profile: DataFrame,
    ledger: DataFrame,
    plan: CohortPlan,
    dims: Dimensions,
    trained: Trained,
    groups: SuffixGroups = SuffixGroups(),
    sample: DataFrame | None = None,
    wanted: list[str] | None = None,
) -> DataFrame:
    """Final scores of every client of the scoring plan, without target columns."""
    features = scoring_features(profile, ledger, plan, dims, trained.params, groups, sample, wanted)
    scores = predict_scoring(features, trained.models, dims)
    return combine(scores, trained.calibration, dims.product_names)


def predict_scoring(features: DataFrame, models: dict[ModelSpec, PipelineModel], dims: Dimensions) -> DataFrame:
    return drop_targets(predict_outcomes(features, models, dims))


def write_scores(scores: DataFrame, project_path: str, directory: str) -> str:
    return score_sink(scores, project_path, directory)
