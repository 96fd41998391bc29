"""Ingress validation, ordered quality rules and reading classifications."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulselake.config import Config, instant
from pulselake.schemas import REQUIRED_FIELDS

VALID = "VALID"

# Class labels.
BATTERY_LABELS = ["critical", "warning", "healthy"]
SIGNAL_LABELS = ["excellent", "good", "fair", "poor"]


@dataclass(frozen=True)
class QualityRule:
    """A rejection reason and the condition under which it applies."""

    name: str
    broken: Column


def first_match(rules: list[QualityRule], otherwise: Column) -> Column:
    """Name of the first broken rule, in list order."""
    head, *rest = rules
    chain = F.when(head.broken, F.lit(head.name))
    return reduce(lambda acc, r: acc.when(r.broken, F.lit(r.name)), rest, chain).otherwise(otherwise)


def quality_rules(cfg: Config = Config(), as_of: datetime | str | None = None) -> list[QualityRule]:
    """The twelve rejection rules, most important first. NULL humidity and battery pass."""
    c = F.col
    when = c("event_timestamp")
    return [
        QualityRule("NULL_DEVICE_ID", c("device_id").isNull()),
        QualityRule("NULL_LATITUDE", c("latitude").isNull()),
        QualityRule("NULL_LONGITUDE", c("longitude").isNull()),
        QualityRule("NULL_TEMPERATURE", c("temperature").isNull()),
        QualityRule("INVALID_LATITUDE", ~c("latitude").between(-90, 90)),
        QualityRule("INVALID_LONGITUDE", ~c("longitude").between(-180, 180)),
        QualityRule(
            "TEMPERATURE_OUT_OF_RANGE",
            ~c("temperature").between(cfg.min_temperature, cfg.max_temperature),
        ),
        QualityRule(
            "HUMIDITY_OUT_OF_RANGE", ~c("humidity").between(cfg.min_humidity, cfg.max_humidity)
        ),
        QualityRule(
            "BATTERY_OUT_OF_RANGE", ~c("battery").between(cfg.min_battery, cfg.max_battery)
        ),
        QualityRule("NULL_TIMESTAMP", when.isNull()),
        QualityRule("FUTURE_TIMESTAMP", when > instant(as_of)),
        QualityRule("TIMESTAMP_TOO_OLD", when < instant(cfg.oldest_event)),
    ]


def quality_status(cfg: Config = Config(), as_of: datetime | str | None = None) -> Column:
    """First broken quality rule, or ``VALID``."""
    return first_match(quality_rules(cfg, as_of), F.lit(VALID))


def ingress_error(cfg: Config = Config(), payload: Column | None = None) -> Column:
    """Reason why an event must not be published, or NULL when it may.

    With ``payload`` (a variant) a field counts as missing when its key is absent; without it a
    NULL column counts as missing. Battery is required but its range is not checked here.
    """
    c = F.col

    def absent(field: str) -> Column:
        if payload is None:
            return c(field).isNull()
        return F.try_variant_get(payload, f"$.{field}", "variant").isNull()

    missing = F.concat_ws(
        ", ", *(F.when(absent(f), F.lit(f)) for f in sorted(REQUIRED_FIELDS))
    )

    def outside(field: str, low: float, high: float, text: str) -> tuple[Column, Column]:
        broken = ~F.coalesce(c(field).between(low, high), F.lit(False))
        shown = F.coalesce(c(field).cast("string"), F.lit("null"))
        return broken, F.concat(F.lit(f"{text}: "), shown)

    checks = [
        outside("latitude", -90, 90, "Invalid latitude"),
        outside("longitude", -180, 180, "Invalid longitude"),
        outside(
            "temperature",
            cfg.min_temperature,
            cfg.max_temperature,
            "Temperature out of sensor range",
        ),
        outside("humidity", cfg.min_humidity, cfg.max_humidity, "Humidity out of range"),
    ]
    chain = F.when(missing != "", F.concat(F.lit("Missing fields: "), missing))
    for broken, reason in checks:
        chain = chain.when(broken, reason)
    return chain


def battery_health(cfg: Config = Config()) -> Column:
    """critical / warning / healthy; an unknown battery counts as healthy."""
    level = F.col("battery")
    return (
        F.when(level < cfg.battery_critical, "critical")
        .when(level < cfg.battery_warning, "warning")
        .otherwise("healthy")
    )


def signal_quality() -> Column:
    """excellent / good / fair / poor; an unknown signal counts as poor."""
    dbm = F.col("signal_strength")
    return (
        F.when(dbm > -50, "excellent")
        .when(dbm > -70, "good")
        .when(dbm > -85, "fair")
        .otherwise("poor")
    )
