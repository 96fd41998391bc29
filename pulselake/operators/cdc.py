"""Change-stream operators: unwrap, rename, apply and route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.operators.dedup import keep_latest


def unwrap_cdc(df: DataFrame) -> DataFrame:
    """Flat after-image with ``__op``, ``__table``, ``__ts_ms`` and ``__deleted``.

    Input columns: ``before`` and ``after`` structs, ``op``, ``source`` struct with ``table``,
    ``ts_ms``; any other columns are carried. A delete gives its before-image with
    ``__deleted`` true; a tombstone (no op) stays as a row of NULLs.
    """
    envelope = {"before", "after", "op", "source", "ts_ms"}
    carried = [c for c in df.columns if c not in envelope]
    return df.withColumn("_image", F.coalesce("after", "before")).select(
        *carried,
        "_image.*",
        F.col("op").alias("__op"),
        F.col("source.table").alias("__table"),
        F.col("ts_ms").alias("__ts_ms"),
        (F.col("op") == "d").alias("__deleted"),
    )


def rename_change_time(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("__ts_ms", "cdc_timestamp_ms").withColumnRenamed(
        "ts_ms", "cdc_timestamp_ms"
    )


def apply_changes(
    df: DataFrame, keys: list[str], order_by: list[Column], operation: str = "cdc_operation"
) -> DataFrame:
    """Current state of each key: its latest change, unless that change is a delete."""
    latest = keep_latest(df, keys, order_by)
    return latest.where(~F.col(operation).eqNullSafe("d"))


def route(df: DataFrame, table: str, column: str = "source_table") -> DataFrame:
    """Changes of one source table."""
    return df.where(F.col(column) == table)
