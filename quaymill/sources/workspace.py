"""Written tables that cut lineage, so that lost executors never force a full recompute."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from quaymill.sources.paths import remove_path

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local-mode session may fall back to one of its own."""
    context = spark.sparkContext
    configured = spark.conf.get(SHARED_DIR, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quaymill-"))
    return context.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/quaymill/{label}-{uuid.uuid4().hex}"


class Scratch:
    """Intermediate tables of one job, under one folder of the shared space.

    As a context manager it removes them at the end; by hand, call ``clear`` once no frame that
    reads them is needed.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = work_path(spark, label)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        self.clear()

    def clear(self) -> None:
        remove_path(self.spark, self.path)

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """Write the frame once and return a scan of what was written."""
        path = f"{self.path}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)
