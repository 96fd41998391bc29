"""Data checks. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulselake.config import Config, instant
from pulselake.operators.incremental import anti_join

# Columns that may not be NULL in Bronze, and in Silver.
BRONZE_NOT_NULL = [
    "device_id",
    "latitude",
    "longitude",
    "temperature",
    "humidity",
    "battery",
    "cdc_operation",
    "event_timestamp",
]
SILVER_NOT_NULL = [c for c in BRONZE_NOT_NULL if c != "cdc_operation"]
ACCEPTED_OPERATIONS = ["r", "c", "u", "d"]
KEY_LENGTH = (3, 50)


def value_ranges(cfg: Config = Config()) -> dict[str, tuple[float, float]]:
    return {
        "latitude": (-90, 90),
        "longitude": (-180, 180),
        "temperature": (cfg.min_temperature, cfg.max_temperature),
        "humidity": (cfg.min_humidity, cfg.max_humidity),
        "battery": (cfg.min_battery, cfg.max_battery),
    }


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns)))


def check_length(df: DataFrame, column: str, low: int = 3, high: int = 50) -> DataFrame:
    return df.where(~F.length(column).between(low, high))


def check_between(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    outside = (~F.col(c).between(low, high) for c, (low, high) in ranges.items())
    return df.where(reduce(lambda a, b: a | b, (F.coalesce(o, F.lit(False)) for o in outside)))


def check_accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(values))


def check_coordinates(silver: DataFrame) -> DataFrame:
    return check_between(silver, {"latitude": (-90, 90), "longitude": (-180, 180)})


def check_times(
    silver: DataFrame, as_of: datetime | str | None = None, cfg: Config = Config()
) -> DataFrame:
    when = F.col("event_timestamp")
    return silver.where((when > instant(as_of)) | (when < instant(cfg.oldest_event)))


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_foreign_key(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key is set but not in the parent table."""
    return anti_join(df.where(F.col(key).isNotNull()), parent, [key])


def check_row_count(df: DataFrame, expected: int) -> DataFrame:
    """One row when the count differs from the expected one."""
    return df.agg(F.count("*").alias("row_count")).where(F.col("row_count") != expected)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def run_counters(df: DataFrame, error: str = "error") -> tuple[DataFrame, Observation]:
    """The frame with counters of valid and invalid rows, filled when it is first written."""
    counters = Observation("run")
    observed = df.observe(
        counters,
        F.count("*").alias("total"),
        F.count_if(F.col(error).isNull()).alias("sent"),
        F.count_if(F.col(error).isNotNull()).alias("invalid"),
    )
    return observed, counters
