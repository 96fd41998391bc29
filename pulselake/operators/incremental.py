"""Incremental loads: watermark filter, replay guard, insert-if-absent."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.config import instant
from pulselake.operators.dedup import keep_latest

OFFSET_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys),
    )


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; NULL keys match NULL keys."""
    return left.alias("l").join(
        right.select(*keys).alias("r"), same_key("l", "r", keys), "left_anti"
    )


def high_watermark(target: DataFrame, column: str) -> datetime | None:
    """Largest value already loaded; one aggregated value reaches the driver."""
    return target.agg(F.max(column)).first()[0]


def incremental(df: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows newer than the newest loaded row; everything when nothing is loaded yet.

    The watermark is read first and passed as a literal, so it is pushed to the source scan.
    """
    loaded = high_watermark(target, column) if target is not None else None
    if loaded is None:
        return df
    return df.where(F.col(column) > instant(loaded))


def skip_processed(df: DataFrame, log: DataFrame) -> DataFrame:
    """Rows whose topic, partition and offset were not processed before, each offset once."""
    fresh = anti_join(df, log, OFFSET_KEY)
    return keep_latest(fresh, OFFSET_KEY, [F.desc("ingested_at")])


def processing_log(df: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Log rows for the offsets of a processed batch."""
    return (
        df.groupBy(*OFFSET_KEY)
        .agg(F.count("*").cast("int").alias("event_count"))
        .select(*OFFSET_KEY, instant(as_of).alias("processed_at"), "event_count")
    )


def insert_absent(
    df: DataFrame, target: DataFrame, keys: list[str], order_by: list[Column] | None = None
) -> DataFrame:
    """Rows to append: keys missing from the target, one row per key."""
    # One row per key: a key with many target rows must not meet in one task.
    fresh = anti_join(df, target.select(*keys).distinct(), keys)
    rest = [F.asc(c) for c in df.columns if c not in keys]
    return keep_latest(fresh, keys, order_by or rest or [F.asc(keys[0])])
