"""What the query modules share: the given tables, the log made of them, and published column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import zone_free
from ..sources.clickstream import clickstream_lanes

SINGLE = {
    "total_time", "pause_time", "pause_time_ratio", "total_time_spent", "avg_time_spent",
    "avg_pause_time", "avg_pause_time_ratio", "avg_stars", "avg_click_reset", "avg_click_retry",
    "total_time_spent_mins", "avg_time_spent_mins", "avg_attempts", "avg_replays",
    "avg_completed_attempts", "avg_errors", "avg_keypad_errors", "avg_shaking_errors",
    "avg_snapping_errors", "avg_hints", "avg_one_star", "avg_two_star", "avg_three_star",
    "avg_incomplete", "mean", "std", "min", "p25", "p50", "p75", "max", "delta_seconds",
}


def published(df: DataFrame) -> DataFrame:
    """Column types of the published tables: single-precision measures, zone-free UTC times."""
    def out(name, kind):
        if name in SINGLE:
            return F.col(name).cast("float").alias(name)
        if kind == "timestamp":
            return zone_free(F.col(name)).alias(name)
        return F.col(name)
    return df.select(*[out(n, t) for n, t in df.dtypes])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lanes(spark, folder):
    return clickstream_lanes(table(spark, folder, "events"))


def log(spark, folder):
    return lanes(spark, folder).merge()
