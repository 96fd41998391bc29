"""Serving queries over Silver and Gold."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pulselake.config import ago, today
from pulselake.functions.numeric import rounded_mean
from pulselake.functions.timeutil import truncate

When = datetime | str | None


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of an ordered frame; ``None`` keeps all."""
    return df if limit is None else df.limit(limit)


def in_region(df: DataFrame, region: str | None) -> DataFrame:
    """Rows of one region; ``None`` or ``All`` keeps everything."""
    return df if region in (None, "All") else df.where(F.col("region") == region)


def last_days(df: DataFrame, as_of: When, days: int, date_col: str = "event_date") -> DataFrame:
    """Rows of the last ``days`` dates before ``as_of`` and of the date itself."""
    return df.where(F.col(date_col) >= F.date_sub(today(as_of), days))


def kpi_summary(summary: DataFrame, as_of: When, days: int = 7, region: str | None = None) -> DataFrame:
    """Headline figures. ``critical_battery_devices`` and ``offline_events`` count device-days."""
    return in_region(last_days(summary, as_of, days), region).agg(
        F.count_distinct("device_id").alias("total_devices"),
        F.sum("total_events").alias("total_events"),
        rounded_mean(F.col("uptime_pct"), 1).alias("avg_uptime"),
        rounded_mean(F.col("avg_temperature"), 1).alias("avg_temperature"),
        F.sum("had_critical_battery").alias("critical_battery_devices"),
        F.sum("had_offline_event").alias("offline_events"),
    )


STATUS_COLUMNS = [
    "device_id",
    "region",
    "last_event_at",
    "uptime_pct",
    "avg_temperature",
    "min_battery",
    "avg_signal_strength",
    "worst_battery_health",
    "device_health_score",
    "had_critical_battery",
    "had_offline_event",
]


def device_status(summary: DataFrame, region: str | None = None) -> DataFrame:
    """Devices on the newest summarised day, worst health first."""
    newest = summary.agg(F.max("event_date")).scalar()
    return (
        in_region(summary.where(F.col("event_date") == newest), region)
        .select(*STATUS_COLUMNS)
        .orderBy(F.asc("device_health_score"), "device_id", "region")
    )


def temperature_trend(
    silver: DataFrame, as_of: When, days: int = 7, region: str | None = None, limit: int | None = None
) -> DataFrame:
    """Hourly temperature by region, newest hours first."""
    recent = silver.where(
        (F.col("event_timestamp") >= ago(as_of, days=days))
        # The date condition prunes partitions.
        & (F.col("event_date") >= F.to_date(ago(as_of, days=days)))
    )
    return (
        in_region(recent, region)
        .groupBy(truncate("hour", F.col("event_timestamp")).alias("hour"), "region")
        .agg(
            rounded_mean(F.col("temperature"), 2).alias("avg_temp"),
            F.round(F.max("temperature"), 2).alias("max_temp"),
            F.round(F.min("temperature"), 2).alias("min_temp"),
        )
        .orderBy(F.desc("hour"), "region")
        .transform(first_rows, limit)
    )


def recent_anomalies(
    anomalies: DataFrame, as_of: When, days: int = 1, region: str | None = None, limit: int | None = None
) -> DataFrame:
    """Newest anomalies of the last day."""
    return (
        in_region(last_days(anomalies, as_of, days), region)
        .select("device_id", "region", "anomaly_type", "severity", "description", "event_timestamp")
        .orderBy(F.desc("event_timestamp"), "device_id", "anomaly_type")
        .transform(first_rows, limit)
    )


def quarantine_breakdown(quarantine: DataFrame, as_of: When, hours: int = 24) -> DataFrame:
    """Rejected rows of the last hours by reason, with their share of the total."""
    total = F.sum("total_quarantined").over(Window.partitionBy())
    return (
        quarantine.where(F.col("quarantined_at") >= ago(as_of, hours=hours))
        .groupBy("rejection_reason")
        .agg(F.count("*").alias("total_quarantined"))
        .withColumn("pct", F.col("total_quarantined") * F.lit(100.0).cast("double") / total)
        .select("total_quarantined", "rejection_reason", "pct")
        .orderBy(F.desc("total_quarantined"), "rejection_reason")
    )


POSITION_COLUMNS = [
    "region",
    "latitude",
    "longitude",
    "temperature",
    "battery",
    "signal_strength",
    "is_online",
]


def latest_readings(silver: DataFrame, columns: list[str]) -> DataFrame:
    """Newest reading of each device.

    Text columns (such as the region) join the grouping of a first step, so its buffers are
    fixed-width and the readings go through hash aggregation without a sort; the second step
    picks the newest of a device's few label combinations.
    """
    labels = [f.name for f in silver.select(*columns).schema if isinstance(f.dataType, StringType)]
    values = [c for c in columns if c not in labels]
    per_label = silver.groupBy("device_id", *labels).agg(
        F.max("event_timestamp").alias("_at"),
        *(F.max_by(c, "event_timestamp").alias(c) for c in values),
    )
    newest = F.max_by(F.struct(*columns), "_at").alias("_newest")
    return per_label.groupBy("device_id").agg(newest).select("device_id", "_newest.*")


def latest_positions(
    silver: DataFrame, as_of: When, hours: int = 2, region: str | None = None, limit: int | None = None
) -> DataFrame:
    """Position and state of devices seen in the last hours.

    A device's newest reading lies in the period exactly when any of its readings does, so the
    period is filtered before the newest reading is taken and the scan reads recent dates only.
    The region applies to the newest reading.
    """
    recent = silver.where(
        (F.col("event_timestamp") >= ago(as_of, hours=hours))
        & (F.col("event_date") >= F.to_date(ago(as_of, hours=hours)))
    )
    return (
        in_region(latest_readings(recent, POSITION_COLUMNS), region)
        .orderBy("device_id")
        .transform(first_rows, limit)
    )


def online_state(flag: str = "is_online") -> Column:
    return F.when(F.col(flag), "online").otherwise("offline")


def health_band(score: str = "device_health_score") -> Column:
    value = F.col(score)
    return F.when(value < 40, "Critical").when(value < 70, "Warning").otherwise("Healthy")


def health_leaderboard(summary: DataFrame, region: str | None = None, limit: int | None = None) -> DataFrame:
    """Worst devices of the newest day with their health band."""
    return (
        device_status(summary, region)
        .transform(first_rows, limit)
        .withColumn("health", health_band())
        .select(
            "device_id",
            "region",
            "health",
            "device_health_score",
            "avg_temperature",
            "min_battery",
            "avg_signal_strength",
            "uptime_pct",
        )
    )


def alert_feed(
    anomalies: DataFrame, as_of: When, days: int = 1, region: str | None = None, limit: int | None = None
) -> DataFrame:
    """Newest anomalies for display: severity marker and time to the minute."""
    return recent_anomalies(anomalies, as_of, days, region, limit).select(
        "device_id",
        "anomaly_type",
        F.when(F.col("severity") == "critical", "red").otherwise("yellow").alias("marker"),
        "description",
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm").alias("seen_at"),
        "region",
    )
