"""A ledger of fits on shared storage: what a training run has finished survives the run.

Every fit has a folder of its own with its model, metrics and importances, and a record that is written last.
Spark commits a table by one rename, so a fit without a record was not finished and is made again. Records carry
a fingerprint of what was asked (model, settings, features): a run with other settings refits. One
project folder stands for one input; a new input takes a new folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ledgercast.operators.models import FittedModel, ModelSpec, SearchSettings
from ledgercast.sources.local_table import local_table
from ledgercast.sources.stages import stage_read, stage_write

RECORD = "model string, fingerprint string, spec string, params string, features array<string>, folder string"


def fingerprint(spec: ModelSpec, features: list[str], settings: SearchSettings) -> str:
    asked = json.dumps([asdict(spec), asdict(settings), features], sort_keys=True)
    return hashlib.md5(asked.encode()).hexdigest()


class FitLedger:
    """The finished fits under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def records(self) -> list:
        """One row per finished fit: as many as there are models and attempts."""
        try:
            return self.spark.read.schema(RECORD).parquet(f"{self.path}/*/*/record").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []

    def find(self, spec: ModelSpec, features: list[str], settings: SearchSettings) -> FittedModel | None:
        """The finished fit of exactly this request; the first by folder if there are two."""
        wanted = fingerprint(spec, features, settings)
        found = sorted((r for r in self.records() if r["fingerprint"] == wanted), key=lambda r: r["folder"])
        if not found:
            return None
        row = found[0]
        model = PipelineModel.load(f"{row['folder']}/model")
        metrics, importances = (stage_read(self.spark, f"{row['folder']}/{name}") for name in ("metrics", "importances"))
        return FittedModel(spec, model, list(row["features"]), metrics, importances, json.loads(row["params"]))

    def commit(self, fitted: FittedModel, features: list[str], settings: SearchSettings) -> None:
        folder = f"{self.path}/{fitted.spec.id}/{uuid.uuid4().hex}"
        fitted.model.write().save(f"{folder}/model")
        stage_write(fitted.metrics.coalesce(1), f"{folder}/metrics")
        stage_write(fitted.importances.coalesce(1), f"{folder}/importances")
        key = fingerprint(fitted.spec, features, settings)
        row = (fitted.spec.id, key, json.dumps(asdict(fitted.spec)), json.dumps(fitted.params), fitted.features, folder)
        stage_write(local_table(self.spark, [row], RECORD).coalesce(1), f"{folder}/record")


def spec_table(spark: SparkSession, specs: list[ModelSpec]) -> DataFrame:
    """``place, spec``: the models of a run in their order, so that a saved run needs no options to be read."""
    return local_table(spark, [(i, json.dumps(asdict(s))) for i, s in enumerate(specs)], "place int, spec string")


def read_specs(table: DataFrame) -> list[ModelSpec]:
    return [ModelSpec(**json.loads(r["spec"])) for r in table.orderBy("place").collect()]
