"""From raw documents to shards: quality rules, near duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written as Parquet and read
again as the next one's documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgercast.llm.decontaminate import drop_contaminated
from ledgercast.llm.mixing import mix_documents
from ledgercast.llm.quality import keep_good
from ledgercast.llm.sharding import shard_documents
from ledgercast.llm.simhash import keep_one_of_each
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

SHARDS = 8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return shard_documents(docs, SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Near duplicates and templates are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), stage_path(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
