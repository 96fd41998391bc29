"""Reader of the hourly JSON archive, for replay."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from pulselake.config import instant
from pulselake.functions.timeutil import truncate
from pulselake.schemas import TELEMETRY

PARTS = ["year", "month", "day", "hour"]


def read_archive(
    spark: SparkSession,
    path: str,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    schema: StructType = TELEMETRY,
) -> DataFrame:
    """Archived events of the hours from ``since`` up to and including ``until``.

    The condition uses the partition columns alone, so other hours are never listed or read.
    """
    layout = StructType(list(schema.fields))
    for part in PARTS:
        layout = layout.add(part, IntegerType())
    df = spark.read.schema(layout).json(path)
    hour = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    if since is not None:
        df = df.where(hour >= truncate("hour", instant(since)))
    if until is not None:
        df = df.where(hour <= truncate("hour", instant(until)))
    return df
