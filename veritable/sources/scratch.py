"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local run without one gets a temporary folder."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if not context.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="veritable-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    It is computed once whatever reads it, survives lost executors, and has a known size, by
    which Spark decides whether to broadcast it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
