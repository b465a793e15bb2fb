"""Session helpers shared by every query: table access and worker import path."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Readers prune columns and push filters into the Parquet scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers on the same machine import this package.

    Clusters ship the repository with ``--py-files``; then the entry added here is simply unused.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the folder that all machines share (``spark.checkpoint.dir``) and read it back.

    Only a session on one machine without that setting gets a folder of its own.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidewave-")
        spark.sparkContext.setCheckpointDir(folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
