"""Session settings that fit every job, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "ledgercast", **settings: str) -> SparkSession:
    """A session with adaptive execution; sizes stay with the cluster's own defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables, reachable from every executor.

    It is the one named in ``spark.checkpoint.dir``. A local folder is made up only where the
    driver and its executors are one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgercast-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one staged table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Tables written meanwhile pass to Python in batches of about ``most`` bytes, of one row at least.

    Spark holds a batch several times outside its heap, and by default fills it up to 64 MB in every task.
    """
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)
