"""Long-form measures exported from Gold."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.config import ago, instant, today
from pulselake.functions.timeutil import epoch_millis

When = datetime | str | Column | None

# Measure name and summary column.
TELEMETRY_MEASURES = {
    "avg_temperature": "avg_temperature",
    "max_temperature": "max_temperature",
    "min_temperature": "min_temperature",
    "avg_humidity": "avg_humidity",
    "min_battery": "min_battery",
    "battery_drain": "battery_drain_today",
    "avg_signal": "avg_signal_strength",
}
HEALTH_MEASURES = {
    "health_score": "device_health_score",
    "uptime_pct": "uptime_pct",
    "active_hours": "active_hours",
    "total_events": "total_events",
}


def today_slice(summary: DataFrame, as_of: When, limit: int | None = None) -> DataFrame:
    """Summary rows of the current date; a limit takes the first devices by name."""
    rows = summary.where(F.col("event_date") == today(as_of))
    return rows if limit is None else rows.orderBy("device_id", "region").limit(limit)


def unpivot_measures(rows: DataFrame, measures: dict[str, str], time: Column) -> DataFrame:
    """One row per device and non-NULL measure, stamped with ``time`` in milliseconds."""
    ids = [
        F.coalesce("device_id", F.lit("unknown")).alias("device_id"),
        F.coalesce("region", F.lit("unknown")).alias("region"),
        epoch_millis(time).alias("time"),
    ]
    wide = rows.select(*ids, *(F.col(c).cast("double").alias(m) for m, c in measures.items()))
    return (
        wide.unpivot(
            ["device_id", "region", "time"], list(measures), "measure_name", "measure_value"
        )
        .where(F.col("measure_value").isNotNull())
        .select(
            "device_id",
            "region",
            "measure_name",
            "measure_value",
            F.lit("DOUBLE").alias("value_type"),
            "time",
        )
    )


def telemetry_measures(rows: DataFrame, as_of: When) -> DataFrame:
    return unpivot_measures(rows, TELEMETRY_MEASURES, instant(as_of))


def health_measures(rows: DataFrame, as_of: When) -> DataFrame:
    return unpivot_measures(rows, HEALTH_MEASURES, instant(as_of))


def anomaly_counts(anomalies: DataFrame, as_of: When, hours: int = 1) -> DataFrame:
    """Anomalies of the last hours by type and region."""
    return (
        anomalies.where(
            (F.col("event_timestamp") >= ago(as_of, hours=hours))
            & (F.col("event_date") >= F.to_date(ago(as_of, hours=hours)))
        )
        .groupBy("anomaly_type", "region")
        .agg(F.count("*").alias("anomaly_count"))
    )


def anomaly_measures(counts: DataFrame, as_of: When) -> DataFrame:
    """Counts as BIGINT measures with default dimension values."""
    return counts.select(
        F.coalesce("anomaly_type", F.lit("UNKNOWN")).alias("anomaly_type"),
        F.coalesce("region", F.lit("unknown")).alias("region"),
        F.lit("anomaly_count").alias("measure_name"),
        F.coalesce("anomaly_count", F.lit(0)).cast("bigint").alias("measure_value"),
        F.lit("BIGINT").alias("value_type"),
        epoch_millis(instant(as_of)).alias("time"),
    )
