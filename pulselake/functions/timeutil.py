"""Time helpers. All timestamps at rest are UTC TIMESTAMP_NTZ; the session runs in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_utc(text: Column) -> Column:
    """ISO-8601 text to a UTC TIMESTAMP_NTZ; text with an offset is converted, bad text is NULL."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def truncate(unit: str, moment: Column) -> Column:
    """date_trunc that stays TIMESTAMP_NTZ."""
    return F.date_trunc(unit, moment).cast("timestamp_ntz")


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two moments (00:00:59 -> 00:01:01 is 1)."""

    def minute_number(moment: Column) -> Column:
        return F.unix_seconds(F.date_trunc("minute", moment))

    return F.call_function("div", minute_number(end) - minute_number(start), F.lit(60))


def time_bin(moment: Column, width: str) -> Column:
    """Start of the tumbling bin of ``width`` (for example ``5 minutes``) holding ``moment``."""
    return F.window(moment, width)["start"]


def epoch_millis(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))
