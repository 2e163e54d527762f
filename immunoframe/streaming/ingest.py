"""Structured Streaming front end: reads that arrive in files, filtered and decoded without state, counted in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import barcodes, filters


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def decode(stream: DataFrame, whitelist: DataFrame, min_quality: float = -1, **layout) -> DataFrame:
    """Reads with barcode, molecule tag and status; a stream-static join, so no state is kept."""
    return barcodes.visium(filters.quality_length(stream, min_quality), whitelist, **layout)


def windowed_counts(stream: DataFrame, time: str, key: str, value: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Count and sum of each key in event-time windows; rows later than the watermark go."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(
        F.col("w.start").alias("start"), key, "n", "total")
