"""Gold: anomaly detection over Silver readings and rolling device statistics."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.config import Config, instant
from pulselake.functions.keys import key_text, surrogate_key
from pulselake.functions.numeric import plain_number, round_ratio
from pulselake.functions.timeutil import minutes_crossed
from pulselake.operators.timeline import (
    BUCKET,
    attach_neighbours,
    bucket_edges,
    hot_days,
    with_bucket,
    with_neighbour,
)
from pulselake.schemas import ANOMALIES

DEVICE = ["device_id"]
LAGGED = ["temperature", "event_timestamp"]
READING_COLUMNS = [
    "device_id",
    "region",
    "event_date",
    "event_timestamp",
    "temperature",
    "battery",
    "signal_strength",
    "is_online",
]


def with_lag(silver: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Adds ``prev_temperature`` and ``prev_event_timestamp`` of the device."""
    return with_neighbour(silver, DEVICE, "event_timestamp", LAGGED, hot=hot)


def device_days(summary: DataFrame) -> DataFrame:
    """Average temperature per device and day.

    The summary has one row per region; a device seen in two regions on one day is combined by
    event count, so a reading never joins more than one row.
    """
    hundredths = F.rint(F.col("avg_temperature") * 100).cast("bigint")
    events = F.when(F.col("avg_temperature").isNotNull(), F.col("total_events"))
    return summary.groupBy("device_id", "event_date").agg(
        round_ratio(
            F.sum(hundredths * F.col("total_events")), F.sum(events) * F.lit(100), 2
        ).alias("avg_temperature"),
        F.sum("total_events").alias("total_events"),
    )


def rolling_stats(days: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Mean and sample deviation of the last ``rolling_rows`` device-day rows.

    ``days`` has one row per device and day, so a device contributes one row per date.
    """
    frame = (
        Window.partitionBy("device_id").orderBy("event_date").rowsBetween(1 - cfg.rolling_rows, 0)
    )
    return days.select(
        "device_id",
        "event_date",
        F.avg("avg_temperature").over(frame).alias("rolling_7d_avg_temp"),
        F.stddev_samp("avg_temperature").over(frame).alias("rolling_7d_stddev_temp"),
    )


def events_with_stats(
    silver: DataFrame, summary: DataFrame, cfg: Config = Config()
) -> DataFrame:
    """Readings with their previous reading, rolling statistics and minutes since the last one.

    The statistics ride on the per-bucket rows that carry the previous reading, so the readings
    meet one join on the keys they are already shuffled by.
    """
    days = device_days(summary)
    hot = hot_days(days, DEVICE, "event_date", "total_events", cfg)
    bucketed = with_bucket(silver.select(*READING_COLUMNS), DEVICE, "event_timestamp", hot)
    carry = (
        bucket_edges(bucketed, DEVICE, "event_timestamp", LAGGED)
        .withColumn("_day", F.to_date(BUCKET))
        .join(
            rolling_stats(days, cfg).withColumnRenamed("event_date", "_day"),
            ["device_id", "_day"],
            "left",
        )
        .drop("_day")
    )
    return (
        attach_neighbours(bucketed, carry, DEVICE, "event_timestamp", LAGGED, "prev_")
        .drop(BUCKET)
        .withColumn(
            "minutes_since_last",
            minutes_crossed(F.col("prev_event_timestamp"), F.col("event_timestamp")),
        )
    )


@dataclass(frozen=True)
class AnomalyRule:
    """One anomaly type: when it fires and what it reports."""

    name: str
    severity: str
    fires: Column
    metric: Column
    threshold: Column
    description: Column


def spike_rule(cfg: Config = Config()) -> AnomalyRule:
    c = F.col
    sigma = c("rolling_7d_stddev_temp")
    threshold = c("rolling_7d_avg_temp") + sigma * cfg.spike_sigmas
    return AnomalyRule(
        "TEMP_SPIKE",
        "critical",
        # A zero deviation never fires.
        (sigma != 0) & (c("temperature") > threshold),
        c("temperature"),
        threshold,
        F.concat(
            F.lit("Temperature "),
            plain_number(c("temperature")),
            F.lit("°C exceeds 3σ threshold of "),
            plain_number(F.round(threshold, 1)),
            F.lit("°C"),
        ),
    )


def reading_rules(cfg: Config = Config()) -> list[AnomalyRule]:
    """Rules that need a single reading only; they also run on a stream."""
    c = F.col

    def number(value: float) -> Column:
        return F.lit(float(value))

    def battery_text(start: str) -> Column:
        return F.concat(F.lit(start), plain_number(c("battery")), F.lit("%"))

    return [
        AnomalyRule(
            "BATTERY_CRITICAL",
            "critical",
            c("battery") < cfg.battery_critical,
            c("battery"),
            number(cfg.battery_critical),
            battery_text("Battery critical at "),
        ),
        AnomalyRule(
            "BATTERY_WARNING",
            "warning",
            c("battery").between(cfg.battery_critical, cfg.battery_warning),
            c("battery"),
            number(cfg.battery_warning),
            battery_text("Battery low at "),
        ),
        AnomalyRule(
            "DEVICE_OFFLINE",
            "warning",
            ~c("is_online"),
            number(0),
            number(1),
            F.lit("Device reported offline"),
        ),
        AnomalyRule(
            "SIGNAL_LOST",
            "warning",
            c("signal_strength") < cfg.signal_lost,
            c("signal_strength").cast("double"),
            number(cfg.signal_lost),
            F.concat(
                F.lit("Signal strength "),
                c("signal_strength").cast("string"),
                F.lit(f" dBm (below {cfg.signal_lost} threshold)"),
            ),
        ),
    ]


def rapid_change_rule(cfg: Config = Config()) -> AnomalyRule:
    c = F.col
    change = F.abs(c("temperature") - c("prev_temperature"))
    return AnomalyRule(
        "RAPID_TEMP_CHANGE",
        "warning",
        (change > cfg.rapid_change) & (c("minutes_since_last") <= cfg.rapid_change_minutes),
        change,
        F.lit(float(cfg.rapid_change)),
        F.concat(
            F.lit("Temperature changed "),
            plain_number(F.round(change, 1)),
            F.lit("°C in "),
            c("minutes_since_last").cast("string"),
            F.lit(" minutes"),
        ),
    )


def all_rules(cfg: Config = Config()) -> list[AnomalyRule]:
    return [spike_rule(cfg), *reading_rules(cfg), rapid_change_rule(cfg)]


def reading_key() -> Column:
    """Identity of an anomaly: device, event time and type."""
    return surrogate_key(
        F.col("device_id"), key_text(F.col("event_timestamp")), F.col("anomaly_type")
    )


def fire(
    readings: DataFrame, rules: list[AnomalyRule], as_of: datetime | str | None = None
) -> DataFrame:
    """One row per reading and rule that fires, in a single pass over the readings.

    Readings without any anomaly are dropped before the rules are expanded.
    """
    hit = reduce(lambda a, b: a | b, (r.fires for r in rules))
    found = F.array(
        *(
            F.when(
                r.fires,
                F.struct(
                    F.lit(r.name).alias("anomaly_type"),
                    F.lit(r.severity).alias("severity"),
                    r.metric.alias("metric_value"),
                    r.threshold.alias("threshold_value"),
                    r.description.alias("description"),
                ),
            )
            for r in rules
        )
    )
    return (
        readings.where(hit)
        .select("device_id", "region", "event_date", "event_timestamp", F.inline(found))
        .where(F.col("anomaly_type").isNotNull())
        .withColumn("anomaly_id", reading_key())
        .withColumn("detected_at", instant(as_of))
        .select(*ANOMALIES.fieldNames())
    )


def verdicts(
    readings: DataFrame, rule: AnomalyRule, as_of: datetime | str | None = None
) -> DataFrame:
    """Every reading as an anomaly row of one rule; ``retracted`` where it does not fire."""
    return (
        readings.withColumns(
            {
                "anomaly_type": F.lit(rule.name),
                "severity": F.lit(rule.severity),
                "metric_value": rule.metric,
                "threshold_value": rule.threshold,
                "description": rule.description,
                "detected_at": instant(as_of),
                "retracted": ~F.coalesce(rule.fires, F.lit(False)),
            }
        )
        .withColumn("anomaly_id", reading_key())
        .select(*ANOMALIES.fieldNames(), "retracted")
    )


def anomalies(
    silver: DataFrame,
    summary: DataFrame,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
) -> DataFrame:
    """All anomalies of Silver. Unordered; use ``newest_first`` when reading."""
    return fire(events_with_stats(silver, summary, cfg), all_rules(cfg), as_of)


def newest_first(found: DataFrame) -> DataFrame:
    return found.orderBy(F.desc("event_timestamp"), "device_id", "anomaly_type")
