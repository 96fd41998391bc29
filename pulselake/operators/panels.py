"""Time-series panels over exported measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.config import ago
from pulselake.functions.numeric import stable_mean
from pulselake.functions.timeutil import epoch_millis, time_bin

When = datetime | str | None

# Lower bounds of the bands above the base colour, per panel.
BANDS = {
    "uptime": ("red", [(90, "yellow"), (98, "green")]),
    "health": ("red", [(50, "orange"), (75, "yellow"), (90, "green")]),
    "anomalies": ("green", [(1, "yellow"), (10, "red")]),
}


def in_range(measures: DataFrame, as_of: When, hours: int = 6) -> DataFrame:
    """Measures newer than ``hours`` before ``as_of``."""
    return measures.where(F.col("time") > epoch_millis(ago(as_of, hours=hours)))


def named(measures: DataFrame, measure: str) -> DataFrame:
    return measures.where(F.col("measure_name") == measure)


def panel_total(measures: DataFrame, measure: str, as_of: When, hours: int = 6) -> DataFrame:
    """Sum of a measure over every snapshot in range, as the panel is written."""
    return in_range(named(measures, measure), as_of, hours).agg(
        F.sum("measure_value").alias("total")
    )


def panel_total_events(measures: DataFrame, as_of: When, hours: int = 6) -> DataFrame:
    return panel_total(measures, "total_events", as_of, hours)


def panel_total_events_latest(measures: DataFrame, as_of: When, hours: int = 6) -> DataFrame:
    """Events in range counted once: the last snapshot of each device, region and date."""
    day = F.to_date(F.timestamp_millis("time")).alias("day")
    last = F.max_by("measure_value", "time").alias("value")
    return (
        in_range(named(measures, "total_events"), as_of, hours)
        .groupBy("device_id", "region", day)
        .agg(last)
        .agg(F.sum("value").alias("total"))
    )


def panel_mean(measures: DataFrame, measure: str, as_of: When, hours: int = 6) -> DataFrame:
    return in_range(named(measures, measure), as_of, hours).agg(
        stable_mean(F.col("measure_value")).alias("mean")
    )


def panel_anomaly_total(counts: DataFrame, as_of: When, hours: int = 24) -> DataFrame:
    """Anomalies of every severity over the range, as the panel is written."""
    return panel_total(counts, "anomaly_count", as_of, hours)


def panel_critical_total(anomalies: DataFrame, as_of: When, hours: int = 24) -> DataFrame:
    """Critical anomalies counted once each, from the anomaly table itself."""
    return anomalies.where(
        (F.col("event_timestamp") > ago(as_of, hours=hours)) & (F.col("severity") == "critical")
    ).agg(F.count("*").alias("total"))


def panel_temperature(measures: DataFrame, as_of: When, hours: int = 6) -> DataFrame:
    """Average temperature per device in five-minute bins, oldest first."""
    moment = F.timestamp_millis("time")
    return (
        in_range(named(measures, "avg_temperature"), as_of, hours)
        .groupBy(time_bin(moment, "5 minutes").cast("timestamp_ntz").alias("time_bin"), "device_id")
        .agg(stable_mean(F.col("measure_value")).alias("avg_temp"))
        .orderBy("time_bin", "device_id")
    )


def panel_anomalies_by_region(counts: DataFrame, as_of: When, hours: int = 6) -> DataFrame:
    return (
        in_range(counts, as_of, hours)
        .groupBy("region", "anomaly_type")
        .agg(F.sum("measure_value").alias("total"))
    )


def band(value: str, panel: str) -> Column:
    """Colour of a panel value; NULL counts as the base band."""
    base, steps = BANDS[panel]
    chain = None
    for bound, colour in reversed(steps):
        test = F.col(value) >= bound
        chain = F.when(test, colour) if chain is None else chain.when(test, colour)
    return chain.otherwise(base)


def last_value(measures: DataFrame, series: list[str]) -> DataFrame:
    """Last non-NULL value of each series."""
    return (
        measures.where(F.col("measure_value").isNotNull())
        .groupBy(*series)
        .agg(
            F.max_by("measure_value", "time").alias("last_value"),
            F.max("time").alias("last_time"),
        )
    )
