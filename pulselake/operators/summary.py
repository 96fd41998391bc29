"""Gold: one row per day, device and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.config import Config
from pulselake.functions.numeric import percentage, round_ratio, rounded_mean
from pulselake.functions.quality import BATTERY_LABELS, SIGNAL_LABELS
from pulselake.schemas import SUMMARY

GRAIN = ["event_date", "device_id", "region"]


def _flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def summary_aggregates(labels: list[str], cfg: Config = Config()) -> list[Column]:
    """All aggregates of the summary, legal in batch and streaming.

    Every buffer is a fixed-width value, so the plan is a hash aggregation with a partial step
    before the shuffle: a device holding a large share of the rows collapses to one row per
    task and day. Distinct hours are bits of one integer; the worst battery label is the
    smallest position in ``labels``.
    """
    c = F.col
    when = c("event_timestamp")
    hour_bit = F.call_function("shiftleft", F.lit(1), F.hour(when))
    label_position = F.array_position(F.array(*map(F.lit, labels)), c("battery_health"))
    worst = F.min(F.when(label_position > 0, label_position))
    return [
        F.count("*").alias("total_events"),
        F.bit_count(F.bit_or(hour_bit)).cast("bigint").alias("active_hours"),
        F.count_if(c("is_online")).alias("_online"),
        rounded_mean(c("temperature"), 2).alias("avg_temperature"),
        F.round(F.min("temperature"), 2).alias("min_temperature"),
        F.round(F.max("temperature"), 2).alias("max_temperature"),
        F.round(F.stddev_samp("temperature"), 4).alias("stddev_temperature"),
        rounded_mean(c("humidity"), 2).alias("avg_humidity"),
        F.round(F.min("humidity"), 2).alias("min_humidity"),
        F.round(F.max("humidity"), 2).alias("max_humidity"),
        F.round(F.min_by("battery", when), 2).alias("battery_start_of_day"),
        F.round(F.max_by("battery", when), 2).alias("battery_end_of_day"),
        F.round(F.min("battery"), 2).alias("min_battery"),
        rounded_mean(c("signal_strength").cast("double"), 1).alias("avg_signal_strength"),
        *(
            F.count_if(c("signal_quality") == label).alias(f"signal_{label}_count")
            for label in SIGNAL_LABELS
        ),
        _flag(c("temperature") > cfg.high_temperature).alias("had_high_temp_alert"),
        _flag(c("battery") < cfg.battery_critical).alias("had_critical_battery"),
        _flag(~c("is_online")).alias("had_offline_event"),
        F.element_at(F.array(*map(F.lit, labels)), worst.cast("int")).alias(
            "worst_battery_health"
        ),
        F.min(when).alias("first_event_at"),
        F.max(when).alias("last_event_at"),
        F.max("ingested_at").alias("last_updated_at"),
    ]


def health_score() -> Column:
    """0..100: 40 % uptime, 30 % battery floor, 30 % share of good signal, one decimal.

    NULL when any input is NULL. Uptime and battery have two decimals, so the score is a ratio
    of whole numbers and is rounded exactly.
    """
    c = F.col
    uptime = F.rint(c("uptime_pct") * 100).cast("bigint")
    battery = F.rint(c("min_battery") * 100).cast("bigint")
    battery = F.when(battery > 10_000, F.lit(10_000)).otherwise(battery)
    good = c("signal_excellent_count") + c("signal_good_count")
    total = c("total_events")
    # score = (4 * uptime + 3 * battery) / 1000 + 30 * good / total
    top = (uptime * 4 + battery * 3) * total + good * 30_000
    score = round_ratio(top, total * 1000, 1)
    return (
        F.when(score.isNull(), F.lit(None).cast("double"))
        .when(score > 100, 100.0)
        .when(score < 0, 0.0)
        .otherwise(score)
    )


def finish_summary(aggregated: DataFrame) -> DataFrame:
    """Derived columns and final column order."""
    return (
        aggregated.withColumn("uptime_pct", percentage(F.col("_online"), F.col("total_events"), 2))
        .withColumn(
            "battery_drain_today",
            F.round(F.col("battery_start_of_day") - F.col("battery_end_of_day"), 2),
        )
        .withColumn("device_health_score", health_score())
        .select(*SUMMARY.fieldNames())
    )


def label_order(severity_order: bool) -> list[str]:
    """Alphabetical order by default; by severity on request (warning before healthy)."""
    return BATTERY_LABELS if severity_order else sorted(BATTERY_LABELS)


def device_summary(
    silver: DataFrame, severity_order: bool = False, cfg: Config = Config()
) -> DataFrame:
    """Daily summary of each device and region."""
    aggregates = summary_aggregates(label_order(severity_order), cfg)
    return finish_summary(silver.groupBy(*GRAIN).agg(*aggregates))
