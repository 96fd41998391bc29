"""Hourly JSON archive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.functions.timeutil import parse_utc
from pulselake.sinks.dead_letter import to_dead_letter
from pulselake.sources.archive import PARTS

RECORDS_PER_FILE = 10_000


def with_hour_parts(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Adds year, month, day and hour of the event time in UTC, as zero-padded text."""
    moment = parse_utc(F.col(time_col))
    # Text formats of the archive folders.
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.withColumns({part: F.date_format(moment, formats[part]) for part in PARTS})


def split_hours(
    df: DataFrame, time_col: str = "timestamp", as_of: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Events with their hour parts, and the dead letters of those whose time is missing or does not parse."""
    placed = with_hour_parts(df, time_col)
    reason = F.when(parse_utc(F.col(time_col)).isNull(), F.lit("No readable event time"))
    payload = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    return placed.where(F.col("year").isNotNull()), to_dead_letter(df, reason, payload, as_of)


def dead_letter_path(path: str) -> str:
    """Where the dead letters of an archive go unless told otherwise: beside it."""
    return f"{path.rstrip('/')}_dead_letters"


def write_archive(
    df: DataFrame,
    path: str,
    time_col: str = "timestamp",
    mode: str = "append",
    dead_letters: str | None = None,
    as_of: datetime | str | None = None,
) -> None:
    """Append events as snappy JSON below ``year=/month=/day=/hour=``.

    Events whose time is missing or does not parse have no hour; they are written to
    ``dead_letters`` (``dead_letter_path`` by default), so that every event is in one of the two.
    """
    placed, unplaced = split_hours(df, time_col, as_of)
    (
        placed.hint("rebalance", *PARTS)
        .write.mode(mode)
        .partitionBy(*PARTS)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "snappy")
        .json(path)
    )
    unplaced.write.mode(mode).parquet(dead_letters or dead_letter_path(path))
