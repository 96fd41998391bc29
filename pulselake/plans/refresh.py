"""Gold kept up to date by change: only what a batch of readings can have altered is made again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.config import Config
from pulselake.operators.anomalies import READING_COLUMNS, anomalies
from pulselake.operators.summary import device_summary
from pulselake.operators.upsert import replace_partitions
from pulselake.schemas import ANOMALIES, SUMMARY
from pulselake.session import release, scratch_path

DEVICE_DAY = ["device_id", "event_date"]


def _held(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _without(table: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows on the dates of ``gone`` (device-days) that are of none of its device-days."""
    near = table.join(gone.select("event_date").distinct(), "event_date", "left_semi")
    return near.join(gone.select(*DEVICE_DAY), DEVICE_DAY, "left_anti")


def affected_days(summary: DataFrame, touched: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Device-days that a change on ``touched`` ones reaches, and those needed to judge them.

    The rolling statistics of a device-day look back over ``rolling_rows`` rows of its device, so
    a change reaches as many rows less one after it, and the first reading of the next row through
    its predecessor. ``affected`` is false for a row that only lends its last reading to the next.
    """
    devices = touched.select("device_id").distinct()
    days = (
        summary.select(*DEVICE_DAY)
        .join(devices, "device_id", "left_semi")
        .distinct()
        .join(touched.select(*DEVICE_DAY).withColumn("_hit", F.lit(1)), DEVICE_DAY, "left")
    )
    by_device = Window.partitionBy("device_id").orderBy("event_date")
    # One row more than the frame when that holds a single row: the predecessor's last reading.
    back = max(cfg.rolling_rows - 1, 1)
    return (
        days.withColumn("affected", F.max("_hit").over(by_device.rowsBetween(-back, 0)).isNotNull())
        .withColumn("_lends", F.coalesce(F.lead("affected").over(by_device), F.lit(False)))
        .where("affected OR _lends")
        .select(*DEVICE_DAY, "affected")
    )


def refresh_gold(
    silver: DataFrame,
    summary_path: str,
    anomalies_path: str,
    touched: DataFrame,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
) -> None:
    """Bring summary and anomalies up to date after a load that changed ``touched`` device-days.

    The touched rows of the summary are aggregated again from Silver. Then the anomalies of the
    device-days that these rows reach are found again: they replace the ones there were, so an
    anomaly that no longer holds goes. Other rows keep the time at which they were detected.
    Repeating the call, also after a crash in the middle, gives the same tables. One writer.
    """
    spark = silver.sparkSession
    held = scratch_path(spark, "refresh")
    touched = _held(touched.select(*DEVICE_DAY).distinct(), f"{held}/touched")
    if touched.isEmpty():
        release(spark, held)
        return
    read_summary = lambda: spark.read.schema(SUMMARY).parquet(summary_path)

    dates = touched.select("event_date").distinct()
    changed = silver.join(dates, "event_date", "left_semi").join(touched, DEVICE_DAY, "left_semi")
    fresh = device_summary(changed, cfg=cfg).select(*SUMMARY.fieldNames())
    old = _without(read_summary(), touched).select(*SUMMARY.fieldNames())
    replace_partitions(old.unionByName(fresh), summary_path, "event_date", ["region"], dates)

    summary = read_summary()
    nearby = _held(affected_days(summary, touched, cfg), f"{held}/nearby")
    affected = nearby.where("affected")
    readings = (
        silver.select(*READING_COLUMNS)
        .join(nearby.select("event_date").distinct(), "event_date", "left_semi")
        .join(nearby.select(*DEVICE_DAY), DEVICE_DAY, "left_semi")
    )
    history = summary.join(touched.select("device_id").distinct(), "device_id", "left_semi")
    found = anomalies(readings, history, cfg, as_of).join(affected, DEVICE_DAY, "left_semi")
    stored = spark.read.schema(ANOMALIES).parquet(anomalies_path)
    names = ANOMALIES.fieldNames()
    merged = _without(stored, affected).select(*names).unionByName(found.select(*names))
    replace_partitions(
        merged, anomalies_path, "event_date", ["anomaly_type"], affected.select("event_date").distinct()
    )
    release(spark, held)
