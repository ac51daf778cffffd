"""Streaming daily summary over hourly snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import clock
from tidemark.operators.rollups import measures


def daily_summary_stream(silver: DataFrame, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Hourly forecasts for the own day, then one row per day and place.

    Both are tumbling windows on the same watermark. A day is emitted once the watermark
    passes its end; rows later than ``delay`` are dropped.
    """
    own_day = F.col("forecast_date_utc") == F.to_date(F.col(event_time))
    hourly = (
        silver.where(F.col("place_name").isNotNull() & own_day)
        .withColumn("_instant", clock.utc_instant(F.col(event_time)))
        .withWatermark("_instant", delay)
        .groupBy(F.window("_instant", "1 hour").alias("hour"), "place_name", "forecast_date_utc")
        .agg(*measures(from_raw=True, rounded=True))
    )
    return (
        hourly.groupBy(F.window("hour", "1 day").alias("day_window"), "place_name")
        .agg(F.min("forecast_date_utc").alias("forecast_date_utc"), *measures(from_raw=False, rounded=True))
        .withColumn("day", F.to_date(clock.instant_utc(F.col("day_window.start"))))
        .drop("day_window")
    )


def start_daily_summary(
    silver: DataFrame, event_time: str, path: str, checkpoint: str, delay: str = "1 hour"
) -> StreamingQuery:
    """Append closed days to a Parquet folder, then stop."""
    return (
        daily_summary_stream(silver, event_time, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
