"""Staged tables, scores and fitted pipelines on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def stage_write(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write Parquet; fail if the path is taken."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def stage_read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write the table once and go on from the files, in the same columns."""
    columns = [f"`{c}`" for c in df.columns]
    return stage_read(df.sparkSession, stage_write(df, path, partition_by)).select(*columns)


def score_sink(scores: DataFrame, project_path: str, directory: str) -> str:
    """Final scores under a named directory of the project."""
    return stage_write(scores, f"{project_path.rstrip('/')}/{directory}")


def model_save(model: PipelineModel, models_path: str, name: str) -> str:
    path = f"{models_path.rstrip('/')}/model_{name}"
    model.write().save(path)
    return path


def model_load(models_path: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{models_path.rstrip('/')}/model_{name}")
