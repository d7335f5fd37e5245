"""Session helpers that hold on a laptop and on a cluster alike."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def expose_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.

    Workers get the driver's PYTHONPATH plus this repository. On a cluster
    without a shared file system ship the package with ``--py-files``.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """df computed once into the shared checkpoint folder, so that what follows neither computes nor plans it again.

    The cluster names the folder in spark.checkpoint.dir; only on one machine a temporary one is taken where it is unset.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or "file://" + tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


#: Input for each core below which rows are dealt anew: a file's splits follow its row groups, and a small file has few.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """df evenly over all cores where it is small; larger inputs are left as they lie.

    For operators whose work on a row outweighs its transfer by far.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(2 * cores) if size < cores * SPREAD_BYTES else df
