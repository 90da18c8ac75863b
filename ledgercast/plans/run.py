"""Run the jobs from a settings file: ``spark-submit … run.py settings.cfg train|score``.

Training writes models, encoding, calibration, importances and the metrics report under the
project folder; scoring reads them back and writes the scores directory.
"""

from __future__ import annotations

import configparser
import json
import sys
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledgercast.dimensions import Dimensions
from ledgercast.operators.models import SearchSettings
from ledgercast.plans.cohort_plan import LEDGER_WINDOW, PROFILE_WINDOW, CohortPlan, CohortSettings, ScoringSettings
from ledgercast.plans.fit_ledger import FitLedger
from ledgercast.plans.jobs import Trained, score_clients, test_report, train, write_scores
from ledgercast.session import build_session
from ledgercast.sources.ledger import open_table, scan_client_sample, scan_ledger, with_dates
from ledgercast.sources.profile import SuffixGroups
from ledgercast.sources.stages import stage_write

# The section with the scoring borders, those of the jobs that read the client sample,
# and the start of a path that means "none".
SCORING_SECTION = "ScoringEpkDateConfigGenerating"
TRAINING_READERS = ("PnlTableFiltering", "MegaTableFiltering")
SCORING_READERS = ("ScoringPnlTableFiltering", "ScoringMegaTableFiltering")
NO_PATH = "no_path"


@dataclass(frozen=True)
class RunSettings:
    training: CohortPlan
    scoring: CohortPlan
    dims: Dimensions
    groups: SuffixGroups
    ledger: str
    profile: str
    project: str
    scores: str
    sample: str | None
    scoring_sample: str | None
    features: list[str] | None

    @classmethod
    def read(cls, path: str) -> RunSettings:
        parser = configparser.ConfigParser(interpolation=None)
        parser.read_string(Path(path).read_text(encoding="utf-8"))
        shared = parser.defaults()
        scoring = parser[SCORING_SECTION] if parser.has_section(SCORING_SECTION) else shared

        def optional(key: str, section: str | None = None) -> str | None:
            """A path, looked up in the job's own section first."""
            own = parser[section] if section and parser.has_section(section) else shared
            value = own.get(key, NO_PATH)
            return None if value.startswith(NO_PATH) else value

        def sample(readers: tuple[str, ...]) -> str | None:
            found = {optional("sample_clients_hdfs_path", section) for section in readers}
            if len(found) > 1:
                raise ValueError(f"{' and '.join(readers)} name different client samples")
            return found.pop()

        features = optional("sample_features_from_mega_path")
        return cls(
            training=CohortPlan.training(
                CohortSettings(
                    history_months=int(shared["count_history_months"]),
                    predict_months=int(shared["count_predict_months"]),
                    buckets=int(shared["number_of_epk_bins"]),
                    train_from=shared["report_dt_train_left_border"],
                    train_months=int(shared["report_dt_train_count"]),
                    train_bucket=int(shared["epk_left_bin_border_train"]),
                    train_width=int(shared["epk_bins_count_train"]),
                    test_from=shared["report_dt_test_left_border"],
                    test_months=int(shared["report_dt_test_count"]),
                    test_bucket=int(shared["epk_left_bin_border_test"]),
                    test_width=int(shared["epk_bins_count_test"]),
                )
            ),
            scoring=CohortPlan.scoring(
                ScoringSettings(
                    history_months=int(shared["count_history_months"]),
                    buckets=int(scoring.get("number_of_epk_bins_scoring", "1")),
                    report_from=scoring["report_dt_scoring_left_border"],
                    report_months=int(scoring.get("report_dt_scoring_count", "1")),
                    first_bucket=int(scoring.get("epk_left_bin_border_scoring", "0")),
                    width=int(scoring.get("epk_bins_count_scoring", "1")),
                )
            ),
            dims=Dimensions.from_json(shared["pnl_products_info_path"], shared["pnl_items_info_path"]),
            groups=SuffixGroups.from_json(shared["mega_features_postfix_groups_path"]),
            ledger=shared["pnl_detail_table"],
            profile=shared["mega_table"],
            project=shared["hdfs_project_path"].rstrip("/"),
            scores=shared["scores_directory_name"],
            sample=sample(TRAINING_READERS),
            scoring_sample=sample(SCORING_READERS),
            features=json.loads(Path(features).read_text(encoding="utf-8")) if features else None,
        )

    def tables(self, spark: SparkSession, plan: CohortPlan, sample: str | None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        clients = scan_client_sample(spark, sample) if sample else None
        profile = with_dates(open_table(spark, self.profile), months=plan.envelope(PROFILE_WINDOW))
        return profile, scan_ledger(spark, self.ledger, plan.envelope(LEDGER_WINDOW)), clients


def run_training(spark: SparkSession, settings: RunSettings, search: SearchSettings = SearchSettings()) -> DataFrame:
    """Fit, save and report; returns the report as written. Started again after a failure, it goes on where it ended."""
    profile, ledger, sample = settings.tables(spark, settings.training, settings.sample)
    trained, _, test = train(
        profile, ledger, settings.training, settings.dims, search, settings.groups, sample, settings.features,
        fits=FitLedger(spark, f"{settings.project}/fits"),
    )
    trained.save(spark, settings.project)
    report = stage_write(test_report(trained, test, settings.dims).coalesce(1), f"{settings.project}/metrics")
    return spark.read.parquet(report)


def run_scoring(spark: SparkSession, settings: RunSettings) -> DataFrame:
    """Score with the saved models; returns the scores as written."""
    profile, ledger, sample = settings.tables(spark, settings.scoring, settings.scoring_sample)
    trained = Trained.load(spark, settings.project, settings.dims)
    scores = score_clients(profile, ledger, settings.scoring, settings.dims, trained, settings.groups, sample, settings.features)
    return spark.read.parquet(write_scores(scores, settings.project, settings.scores))


JOBS = {"train": run_training, "score": run_scoring}


def main() -> None:
    path, job = sys.argv[1:3]
    JOBS[job](build_session(), RunSettings.read(path))


if __name__ == "__main__":
    main()
