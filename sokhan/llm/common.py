"""What the training-data operators share: folders, table access, text to bytes."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
#: Lower-cases A-Z only, byte for byte.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may only be readable by Spark."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Workers can import this package; a checkpoint folder is set.

    The cluster names the shared folder in spark.checkpoint.dir. Only where it
    is unset and everything runs on one machine (tests) a temporary folder is taken.
    """
    sc = spark.sparkContext
    parts = [p for p in sc.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in parts:
        sc.environment["PYTHONPATH"] = os.pathsep.join([*parts, ROOT])
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or "file://" + tempfile.mkdtemp(prefix="checkpoint-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the shared checkpoint folder."""
    prepare(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base if "://" in base else "file://" + base.removeprefix("file:")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, the one knob that follows the input's size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> list[bytes]:
    """A string column's values as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str, out: pa.Schema) -> DataFrame:
    """Map Arrow batches through fn, a dict of columns for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch), schema=out)

    return df.mapInArrow(run, schema)


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns as one struct ``row`` beside others, so that no name of theirs can clash."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), *more)


def unpacked(df: DataFrame, names: list[str], **added: Column) -> DataFrame:
    """The columns of ``row`` again, then those added; an added one replaces its namesake."""
    return df.select(*(F.col("row")[c].alias(c) for c in names if c not in added), *(v.alias(c) for c, v in added.items()))


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that an operator reads, under its own names."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
