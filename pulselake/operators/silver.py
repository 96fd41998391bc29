"""Silver: deduplicate, classify, split and project."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.config import Config, instant
from pulselake.functions.quality import VALID, battery_health, quality_status, signal_quality
from pulselake.operators.dedup import READING_KEY, change_order, keep_latest
from pulselake.schemas import SILVER


def classify(
    bronze: DataFrame, cfg: Config = Config(), as_of: datetime | str | None = None
) -> DataFrame:
    """Latest version of each reading with its ``dq_status``.

    Deduplication looks at every version: an invalid newest version hides an older valid one.
    The status belongs to one row, so it is set before the shuffle, and the payload, which only
    quarantine needs, travels with rejected rows alone.
    """
    judged = bronze.withColumn("dq_status", quality_status(cfg, as_of))
    if "raw_payload" in bronze.columns:
        rejected = F.col("dq_status") != VALID
        judged = judged.withColumn("raw_payload", F.when(rejected, F.col("raw_payload")))
    return keep_latest(judged, READING_KEY, change_order())


def split_valid(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = F.col("dq_status") == VALID
    return classified.where(valid), classified.where(~valid)


def silver_columns(valid: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Silver projection of valid readings. ``event_timestamp`` is UTC already (Bronze)."""
    return (
        valid.withColumn("event_date", F.to_date("event_timestamp"))
        .withColumn("battery_health", battery_health(cfg))
        .withColumn("signal_quality", signal_quality())
        .select(*SILVER.fieldNames())
    )


def silver(
    bronze: DataFrame, cfg: Config = Config(), as_of: datetime | str | None = None
) -> DataFrame:
    """Valid, deduplicated, classified readings."""
    return silver_columns(split_valid(classify(bronze, cfg, as_of))[0], cfg)


def quarantine_columns(invalid: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Quarantine projection of rejected readings; the payload is kept when Bronze carries it."""
    payload = [F.col("raw_payload").alias("original_payload")] if "raw_payload" in invalid.columns else []
    return invalid.select(
        "device_id",
        "event_timestamp",
        "kafka_offset",
        "kafka_partition",
        F.col("dq_status").alias("rejection_reason"),
        *payload,
        F.col("ingested_at").alias("quarantined_at"),
        instant(as_of).alias("reviewed_at"),
        F.lit(False).alias("is_resolved"),
    )


def quarantine(
    bronze: DataFrame, cfg: Config = Config(), as_of: datetime | str | None = None
) -> DataFrame:
    """Rejected readings with their reason."""
    return quarantine_columns(split_valid(classify(bronze, cfg, as_of))[1], as_of)
