"""Alert rows, alert lifecycle, metric alarms and repeat suppression."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.config import Config, ago
from pulselake.functions.keys import key_text, surrogate_key
from pulselake.functions.numeric import stable_mean
from pulselake.functions.timeutil import time_bin
from pulselake.operators.timeline import with_neighbour
from pulselake.schemas import DEVICE_ALERTS
from pulselake.session import stage

When = datetime | str | None

# Alert type of each anomaly type that raises a device alert.
ALERT_TYPES = {
    "TEMP_SPIKE": "high_temp",
    "BATTERY_CRITICAL": "low_battery",
    "BATTERY_WARNING": "low_battery",
    "DEVICE_OFFLINE": "offline",
}


def alert_filter(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Readings that are too hot or nearly out of battery; batch or stream."""
    hot = F.col("temperature") > cfg.high_temperature
    return df.where(hot | (F.col("battery") < cfg.battery_critical))


def device_alerts(anomalies: DataFrame) -> DataFrame:
    """Open alert rows for anomalies of an alert type."""
    types = F.create_map(*(F.lit(x) for pair in ALERT_TYPES.items() for x in pair))
    return (
        anomalies.where(F.col("anomaly_type").isin(*ALERT_TYPES))
        .select(
            F.col("anomaly_id").alias("id"),
            "device_id",
            F.element_at(types, F.col("anomaly_type")).alias("alert_type"),
            "severity",
            F.col("description").alias("message"),
            F.col("event_timestamp").alias("triggered_at"),
            F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
            F.lit(False).alias("is_resolved"),
        )
        .select(*DEVICE_ALERTS.fieldNames())
    )


def alert_conditions(cfg: Config = Config()) -> dict[str, tuple[str, Column]]:
    """Alert type, severity and the condition that keeps an alert open."""
    c = F.col
    return {
        "high_temp": ("critical", c("temperature") > cfg.high_temperature),
        "low_battery": ("critical", c("battery") < cfg.battery_critical),
        "offline": ("warning", ~c("is_online")),
    }


def alert_episodes(
    silver: DataFrame, cfg: Config = Config(), hot: DataFrame | None = None
) -> DataFrame:
    """Alerts with their lifecycle.

    An alert opens at the first reading of a device that meets a condition and is resolved by
    the device's next reading that does not. Readings that change no state are dropped before
    opening and resolving readings are paired; the remaining state changes are staged, as the
    pairing reads them in several branches.
    """
    conditions = alert_conditions(cfg)
    flags = {f"_{name}": F.coalesce(test, F.lit(False)) for name, (_, test) in conditions.items()}
    readings = silver.select("device_id", "event_timestamp", *(f.alias(n) for n, f in flags.items()))
    lagged = with_neighbour(
        readings, ["device_id"], "event_timestamp", list(flags), prefix="_was", hot=hot
    )
    changes = F.array(
        *(
            F.when(
                F.col(f"_{name}") != F.coalesce(F.col(f"_was_{name}"), F.lit(False)),
                F.struct(
                    F.lit(name).alias("alert_type"),
                    F.lit(severity).alias("severity"),
                    F.col(f"_{name}").alias("opens"),
                ),
            )
            for name, (severity, _) in conditions.items()
        )
    )
    transitions = lagged.select("device_id", "event_timestamp", F.inline(changes)).where(
        F.col("alert_type").isNotNull()
    )
    paired = with_neighbour(
        stage(transitions.withColumn("_time", F.col("event_timestamp")), "state-changes"),
        ["device_id", "alert_type"],
        "event_timestamp",
        ["_time"],
        forward=True,
        prefix="_next",
    )
    return (
        paired.where("opens")
        .select(
            surrogate_key(
                F.col("device_id"), key_text(F.col("event_timestamp")), F.col("alert_type")
            ).alias("id"),
            "device_id",
            "alert_type",
            "severity",
            F.concat(F.col("alert_type"), F.lit(" since "), key_text(F.col("event_timestamp"))).alias(
                "message"
            ),
            F.col("event_timestamp").alias("triggered_at"),
            F.col("_next_time").alias("resolved_at"),
            F.col("_next_time").isNotNull().alias("is_resolved"),
        )
        .select(*DEVICE_ALERTS.fieldNames())
    )


def unresolved(alerts: DataFrame) -> DataFrame:
    return alerts.where(~F.col("is_resolved"))


def newest_alert(alerts: DataFrame) -> DataFrame:
    """Newest alert of each device; ties go to the smaller alert type."""
    newest = F.min_by(
        F.struct("alert_type", "severity", "triggered_at", "is_resolved"),
        F.struct((-F.unix_micros(F.col("triggered_at").cast("timestamp"))).alias("age"), "alert_type"),
    )
    return alerts.groupBy("device_id").agg(newest.alias("_n")).select("device_id", "_n.*")


def resolve_alerts(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Sets ``resolved_at`` of open alerts from ``resolutions`` (id, resolved_at)."""
    fresh = resolutions.groupBy("id").agg(F.min("resolved_at").alias("_resolved"))
    joined = alerts.join(fresh, "id", "left")
    return joined.select(
        *(c for c in alerts.columns if c not in ("resolved_at", "is_resolved")),
        F.coalesce("resolved_at", "_resolved").alias("resolved_at"),
        F.coalesce("resolved_at", "_resolved").isNotNull().alias("is_resolved"),
    ).select(*alerts.columns)


def quarantine_spike(
    quarantine: DataFrame, as_of: When, threshold: int, hours: int = 1
) -> DataFrame:
    """Rejection reasons of the last hours with more than ``threshold`` rows."""
    return (
        quarantine.where(F.col("quarantined_at") >= ago(as_of, hours=hours))
        .groupBy("rejection_reason")
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > threshold)
    )


COMPARISONS = {
    ">": lambda v, t: v > t,
    ">=": lambda v, t: v >= t,
    "<": lambda v, t: v < t,
    "<=": lambda v, t: v <= t,
}


def metric_alarm(
    df: DataFrame,
    series: list[str],
    time_col: str,
    value: str,
    op: str,
    threshold: float,
    periods: int,
    period: str = "5 minutes",
    missing: str = "missing",
) -> DataFrame:
    """State of an alarm per series and period: ALARM, OK or INSUFFICIENT_DATA.

    The average of each period is compared with the threshold; ``periods`` breaches in a row
    raise the alarm. Periods without data between the first and last one of a series are
    ``breaching``, ``not_breaching`` or ``missing``. Readings are averaged before anything
    else, so a series enters the window with one row per period.
    """
    averaged = df.groupBy(
        *series, time_bin(F.col(time_col), period).alias("period_start")
    ).agg(stable_mean(F.col(value)).alias("average"))
    step = F.expr(f"INTERVAL {period}")
    grid = (
        averaged.groupBy(*series)
        .agg(F.sequence(F.min("period_start"), F.max("period_start"), step).alias("_periods"))
        .select(*series, F.explode("_periods").alias("period_start"))
    )
    filler = {"breaching": F.lit(1), "not_breaching": F.lit(0), "missing": F.lit(None).cast("int")}
    breach = F.when(
        F.col("average").isNotNull(),
        COMPARISONS[op](F.col("average"), F.lit(threshold)).cast("int"),
    ).otherwise(filler[missing])
    recent = Window.partitionBy(*series).orderBy("period_start").rowsBetween(1 - periods, 0)
    seen = F.count("_breach").over(recent)
    return (
        grid.join(averaged, [*series, "period_start"], "left")
        .withColumn("_breach", breach)
        .withColumn("_seen", seen)
        .withColumn("_all", F.min("_breach").over(recent))
        .select(
            *series,
            "period_start",
            "average",
            F.when(F.col("_seen") < periods, "INSUFFICIENT_DATA")
            .when(F.col("_all") == 1, "ALARM")
            .otherwise("OK")
            .alias("state"),
        )
    )


def throttle(
    alerts: DataFrame,
    group_cols: list[str],
    time_col: str = "event_timestamp",
    interval: str = "4 hours",
) -> DataFrame:
    """At most one notice per group and interval: its first alert and how many it stands for.

    Intervals are aligned to the clock, so the groups reduce by partial aggregation in batch
    and in a stream.
    """
    return (
        alerts.groupBy(*group_cols, time_bin(F.col(time_col), interval).alias("interval_start"))
        .agg(F.min(time_col).alias("notified_at"), F.count("*").alias("alert_count"))
        .select(*group_cols, "interval_start", "notified_at", "alert_count")
    )


def low_battery(silver: DataFrame, cfg: Config = Config()) -> DataFrame:
    return silver.where(F.col("battery") < cfg.battery_warning)


def offline(silver: DataFrame) -> DataFrame:
    return silver.where(~F.col("is_online"))


def active_devices(registry: DataFrame, region: str | None = None) -> DataFrame:
    active = registry.where("is_active")
    return active if region is None else active.where(F.col("region") == region)
