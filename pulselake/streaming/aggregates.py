"""Event-time aggregations on a stream of deduplicated, valid readings.

Watermarks need TIMESTAMP, so the UTC event time is cast before ``withWatermark``. Every
aggregate has a partial step before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.config import Config
from pulselake.functions.numeric import rounded_mean, stable_mean
from pulselake.operators.summary import finish_summary, label_order, summary_aggregates


def with_event_time(readings: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    return readings.withColumn(
        "event_time", F.col("event_timestamp").cast("timestamp")
    ).withWatermark("event_time", lateness)


def five_minute_temperature(readings: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Average temperature per device in five-minute tumbling windows."""
    return (
        with_event_time(readings, lateness)
        .groupBy(F.window("event_time", "5 minutes").alias("w"), "device_id")
        .agg(stable_mean(F.col("temperature")).alias("avg_temp"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("time_bin"), "device_id", "avg_temp"
        )
    )


def hourly_trend(readings: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Hourly temperature by region."""
    return (
        with_event_time(readings, lateness)
        .groupBy(F.window("event_time", "1 hour").alias("w"), "region")
        .agg(
            rounded_mean(F.col("temperature"), 2).alias("avg_temp"),
            F.round(F.max("temperature"), 2).alias("max_temp"),
            F.round(F.min("temperature"), 2).alias("min_temp"),
        )
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("hour"),
            "region",
            "avg_temp",
            "max_temp",
            "min_temp",
        )
    )


def device_day(
    readings: DataFrame,
    lateness: str = "1 day",
    severity_order: bool = False,
    cfg: Config = Config(),
) -> DataFrame:
    """Device-day summary with the same aggregates as the batch form."""
    aggregated = (
        with_event_time(readings, lateness)
        .groupBy(F.window("event_time", "1 day").alias("w"), "device_id", "region")
        .agg(*summary_aggregates(label_order(severity_order), cfg))
        .withColumn("event_date", F.to_date("w.start"))
        .drop("w")
    )
    return finish_summary(aggregated)


def throttled_notices(alerts: DataFrame, group_cols: list[str], interval: str = "4 hours") -> DataFrame:
    """At most one notice per group and interval (stream form of ``throttle``).

    Without a watermark, so no alert is too late. The state is one row per group and interval,
    whatever the number of alerts.
    """
    return (
        alerts.groupBy(F.window(F.col("event_timestamp").cast("timestamp"), interval).alias("w"), *group_cols)
        .agg(F.min("event_timestamp").alias("notified_at"), F.count("*").alias("alert_count"))
        .select(
            *group_cols,
            F.col("w.start").cast("timestamp_ntz").alias("interval_start"),
            "notified_at",
            "alert_count",
        )
    )
