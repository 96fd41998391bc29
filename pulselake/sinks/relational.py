"""Relational sink: field selection, renames and batched writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.config import instant
from pulselake.functions.timeutil import parse_utc
from pulselake.operators.dedup import READING_KEY, keep_latest
from pulselake.operators.upsert import upsert

BATCH_ROWS = 3_000

# Fields passed on to the relational table.
SINK_FIELDS = [
    "device_id",
    "region",
    "latitude",
    "longitude",
    "temperature",
    "humidity",
    "battery",
    "speed",
    "signal_strength",
    "is_online",
    "event_type",
]


def relational_rows(
    df: DataFrame, as_of: datetime | str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Whitelisted fields, ``timestamp`` renamed to ``event_timestamp``, ``ingested_at`` added.

    ``carry`` names columns that order the versions of a reading, which ``upsert_relational`` needs.
    """
    return (
        df.select(*SINK_FIELDS, "timestamp", *carry)
        .withColumnRenamed("timestamp", "event_timestamp")
        .withColumn("event_timestamp", parse_utc(F.col("event_timestamp")))
        .withColumn("ingested_at", instant(as_of))
    )


def collapse(df: DataFrame, order_by: list | None = None) -> DataFrame:
    """One row per reading key, so an upsert never sees a key twice in a batch."""
    order = order_by or [F.desc("ingested_at"), *(F.asc(c) for c in SINK_FIELDS)]
    return keep_latest(df, READING_KEY, order)


def upsert_relational(rows: DataFrame, path: str, order_by: list[str]) -> None:
    """Upsert into the lake form of the relational table, by reading key.

    Of the versions of a reading the one with the highest ``order_by`` values stays, in whatever
    order batches arrive; the table keeps these columns to tell. Rows without a time have no
    place in the table and are left out; those without a device share the key that lacks it.
    """
    keyed = rows.dropna(subset=["event_timestamp"]).withColumn("event_date", F.to_date("event_timestamp"))
    upsert(keyed, path, READING_KEY, "event_date", order_by)


def write_relational(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None
) -> None:
    """Append to a staging table over JDBC; the database merges it by key.

    Needs a reachable database and its driver, so it is not exercised here.
    ``upsert_relational`` is the lake form of the same sink.
    """
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.option("batchsize", BATCH_ROWS).mode("append").save()
