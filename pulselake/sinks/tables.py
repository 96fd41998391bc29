"""Lake table writers: full rebuild, clustered layout, schema alignment, retention, tiers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulselake.config import instant, today

# Retention in days by layer or topic.
RETENTION_DAYS = {
    "raw": 1,
    "silver": 7,
    "gold": 90,
    "topic_events": 7,
    "topic_changes": 30,
    "topic_dead_letter": 3,
    "measures_hot": 1,
    "measures": 365,
    "measures_anomaly_counts": 90,
}
# Age in days from which a storage tier applies.
TIER_AGES = {"infrequent": 90, "archive": 365}


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str,
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
    only_touched: bool = False,
) -> None:
    """Write Parquet folders per ``partition_col``, sorted inside each file.

    The rebalance hint sizes the writing tasks from the real data: small partitions share a
    task and a partition that holds a large share of the rows is split over several. With
    ``only_touched`` an overwrite replaces the partitions present in ``df`` and no others.
    """
    layout = df.hint("rebalance", partition_col)
    if sort_by:
        layout = layout.sortWithinPartitions(partition_col, *sort_by)
    overwrite = "dynamic" if only_touched else "static"
    (
        layout.write.mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .partitionBy(partition_col)
        .parquet(path)
    )


def rebuild(df: DataFrame, path: str, partition_col: str, sort_by: list[str] | None = None) -> None:
    """Full rebuild of a Gold table, clustered by ``(partition_col, sort_by)``."""
    write_partitioned(df, path, partition_col, sort_by)


def align_schema(df: DataFrame, target: StructType) -> DataFrame:
    """The frame under the target's columns: missing ones NULL, vanished ones removed."""
    have = set(df.columns)
    return df.select(
        *(
            F.col(f.name).cast(f.dataType)
            if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        )
    )


def schema_changes(old: StructType, new: StructType) -> dict[str, list[str]]:
    """Columns added and removed between two schemas."""
    before, after = old.fieldNames(), new.fieldNames()
    return {
        "added": [c for c in after if c not in before],
        "removed": [c for c in before if c not in after],
    }


def retention_filter(
    df: DataFrame, time_col: str, days: int, as_of: datetime | str | None = None
) -> DataFrame:
    """Rows inside the retention period."""
    return df.where(F.col(time_col) >= instant(as_of) - F.make_dt_interval(F.lit(days)))


def expired_partitions(
    df: DataFrame, date_col: str, days: int, as_of: datetime | str | None = None
) -> DataFrame:
    """Dates past the retention period with their row counts."""
    return (
        df.where(F.col(date_col) < F.date_sub(today(as_of), days))
        .groupBy(date_col)
        .agg(F.count("*").alias("row_count"))
    )


def storage_tier(date_col: str, as_of: datetime | str | None = None) -> Column:
    """Storage tier of a partition by its age."""
    age = F.date_diff(today(as_of), F.col(date_col))
    return (
        F.when(age >= TIER_AGES["archive"], "archive")
        .when(age >= TIER_AGES["infrequent"], "infrequent")
        .otherwise("standard")
    )
