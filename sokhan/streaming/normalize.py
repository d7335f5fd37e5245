"""Streaming, an extension. The rules are stateless, so append mode does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sokhan.normalizer import Config, normalized


def normalize_stream(df: DataFrame, text_col: str = "text", config: Config = Config()) -> DataFrame:
    """The same columns as in a batch."""
    return normalized(df, text_col, config)


def windowed_counts(df: DataFrame, ts: str, key: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows by window and key; rows later than the watermark are left out."""
    return df.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
