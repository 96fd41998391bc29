"""Keep-latest deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READING_KEY = ["device_id", "event_timestamp"]


def change_order() -> list[Column]:
    """Newest change first: offset, then change time, then partition as the final tie-break."""
    return [
        F.desc("kafka_offset"),
        F.desc("cdc_timestamp_ms"),
        F.desc("kafka_partition"),
    ]


def keep_latest(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key, the first in ``order_by``; NULL keys form one group.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each task sends at
    most one row per key, so a key holding a large share of the rows (such as NULL device and
    NULL time) does not land in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
