"""Thresholds and the pinned clock shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    """Limits used by quality rules, classifications and anomaly rules."""

    min_temperature: float = -50.0
    max_temperature: float = 80.0
    min_humidity: float = 0.0
    max_humidity: float = 100.0
    min_battery: float = 0.0
    max_battery: float = 100.0
    oldest_event: str = "2020-01-01 00:00:00"

    battery_critical: float = 10.0
    battery_warning: float = 20.0
    high_temperature: float = 50.0
    signal_lost: int = -90

    spike_sigmas: float = 3.0
    rolling_rows: int = 7
    rapid_change: float = 10.0
    rapid_change_minutes: int = 5

    # A device-day above max(hot_floor, total * hot_share) rows is split more finely.
    # At most 1 / hot_share device-days can exceed the share, which bounds the broadcast.
    hot_share: float = 1e-4
    hot_floor: int = 1_000_000


def instant(as_of: datetime | str | Column | None) -> Column:
    """``as_of`` as a UTC TIMESTAMP_NTZ column; ``None`` means the current time."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def ago(as_of: datetime | str | Column | None, **parts: int) -> Column:
    """``as_of`` minus an interval, for example ``ago(t, hours=2)``."""
    return instant(as_of) - F.make_dt_interval(
        *(F.lit(parts.get(unit, 0)) for unit in ("days", "hours", "mins"))
    )


def today(as_of: datetime | str | Column | None) -> Column:
    return F.to_date(instant(as_of))
