"""Batch medallion flow: raw landing to Silver, quarantine and Gold tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType

from pulselake.config import Config, instant
from pulselake.functions.quality import VALID
from pulselake.operators import checks
from pulselake.operators.anomalies import anomalies
from pulselake.operators.bronze import bronze
from pulselake.operators.dedup import READING_KEY
from pulselake.operators.incremental import high_watermark
from pulselake.operators.silver import classify, quarantine_columns, silver_columns
from pulselake.operators.summary import device_summary
from pulselake.operators.upsert import upsert
from pulselake.plans.refresh import DEVICE_DAY, refresh_gold
from pulselake.schemas import ANOMALIES, QUARANTINE, RAW, SILVER, SUMMARY
from pulselake.session import path_exists, release, scratch_path
from pulselake.sinks.tables import rebuild
from pulselake.sources.tables import read_table

LOADS = StructType([StructField("covered", TimestampNTZType())])
QUARANTINE_KEY = [*READING_KEY, "kafka_offset"]


@dataclass(frozen=True)
class Lake:
    """Table locations below one root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def loads(self) -> str:
        """Log of finished loads: the newest ingest time that each of them covered."""
        return f"{self.root}/loads"

    @property
    def summary(self) -> str:
        return f"{self.root}/device_summary"

    @property
    def anomalies(self) -> str:
        return f"{self.root}/anomalies"

    def read_raw(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.raw, RAW)

    def read_silver(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.silver, SILVER)

    def read_quarantine(self, spark: SparkSession) -> DataFrame:
        schema = StructType([*QUARANTINE.fields, StructField("time_band", DateType())])
        return read_table(spark, self.quarantine, schema)

    def read_summary(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.summary, SUMMARY)

    def read_anomalies(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.anomalies, ANOMALIES)


def time_band(moment: Column) -> Column:
    """Partition date of a quarantined reading.

    It follows from the key, so a key never moves; missing and absurd times share fixed dates,
    so bad clocks cannot create unbounded numbers of partitions.
    """
    return (
        F.when(moment.isNull(), F.make_date(F.lit(1900), F.lit(1), F.lit(1)))
        .when(F.year(moment) < 2020, F.make_date(F.lit(1900), F.lit(1), F.lit(2)))
        .when(F.year(moment) > 2100, F.make_date(F.lit(9999), F.lit(12), F.lit(31)))
        .otherwise(F.to_date(moment))
    )


def stage_classified(
    readings: DataFrame, path: str, cfg: Config = Config(), as_of: datetime | str | None = None
) -> DataFrame:
    """Classified readings written once to ``path`` in the shared folder and read back.

    Both targets read the written table, so the deduplication shuffle runs once and a lost
    executor does not repeat it.
    """
    spark = readings.sparkSession
    classified = classify(readings, cfg, as_of).withColumn("_valid", F.col("dq_status") == VALID)
    classified.write.partitionBy("_valid").parquet(path)
    return spark.read.schema(classified.schema).parquet(path)


def load_silver(
    readings: DataFrame,
    lake: Lake,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
    then: list[Callable[[DataFrame], None]] | None = None,
) -> None:
    """Upsert one batch of Bronze readings into Silver and quarantine.

    ``then`` runs on the valid part before the staged batch is deleted.
    """
    spark = readings.sparkSession
    path = scratch_path(spark, "classified")
    classified = stage_classified(readings, path, cfg, as_of)
    valid = silver_columns(classified.where("_valid"), cfg)
    rejected = quarantine_columns(classified.where("NOT _valid"), as_of).withColumn(
        "time_band", time_band(F.col("event_timestamp"))
    )
    upsert(
        valid,
        lake.silver,
        READING_KEY,
        "event_date",
        order_by=["kafka_offset", "kafka_partition"],
        sort_by=["region"],
        staged=True,
    )
    upsert(
        rejected,
        lake.quarantine,
        QUARANTINE_KEY,
        "time_band",
        order_by=["kafka_partition", "quarantined_at"],
        staged=True,
    )
    for step in then or []:
        step(valid)
    release(spark, path)


def rebuild_gold(
    spark: SparkSession, lake: Lake, cfg: Config = Config(), as_of: datetime | str | None = None
) -> None:
    """Rebuild the device summary and the anomalies from Silver.

    Anomalies read the summary table just written, not a second aggregation of Silver.
    """
    silver = lake.read_silver(spark)
    rebuild(device_summary(silver, cfg=cfg), lake.summary, "event_date", ["region"])
    found = anomalies(silver, lake.read_summary(spark), cfg, as_of)
    rebuild(found, lake.anomalies, "event_date", ["anomaly_type"])


def refresh_step(
    lake: Lake, cfg: Config = Config(), as_of: datetime | str | None = None
) -> Callable[[DataFrame], None]:
    """Step after ``load_silver``: Gold follows the device-days of the batch's valid readings.

    Where there is no Gold yet it is built whole.
    """

    def step(valid: DataFrame) -> None:
        spark = valid.sparkSession
        if not (path_exists(spark, lake.summary) and path_exists(spark, lake.anomalies)):
            rebuild_gold(spark, lake, cfg, as_of)
            return
        touched = valid.select(*DEVICE_DAY)
        refresh_gold(lake.read_silver(spark), lake.summary, lake.anomalies, touched, cfg, as_of)

    return step


def last_load(spark: SparkSession, lake: Lake) -> datetime | None:
    """Newest ingest time that a finished load covered.

    A load is logged after Silver and quarantine both hold it, so a run that failed between the
    two is repeated whole. The log has one small row per load; no table is scanned.
    """
    return high_watermark(read_table(spark, lake.loads, LOADS), "covered")


def run(
    raw: DataFrame,
    lake: Lake,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
    incremental: bool = True,
) -> None:
    """One scheduled run: new raw rows to Silver and quarantine, then Gold.

    An incremental run changes Gold where the new rows reach, before the load is logged: a run
    that failed is repeated whole. Otherwise Gold is rebuilt from all of Silver.
    """
    spark = raw.sparkSession
    since = last_load(spark, lake) if incremental else None
    if since is not None:
        raw = raw.where(F.col("ingested_at") > instant(since))
    covered = high_watermark(raw, "ingested_at")
    load_silver(bronze(raw), lake, cfg, as_of, [refresh_step(lake, cfg, as_of)] if incremental else None)
    if covered is not None:
        spark.createDataFrame([(covered,)], LOADS).coalesce(1).write.mode("append").parquet(lake.loads)
    if not incremental:
        rebuild_gold(spark, lake, cfg, as_of)


def silver_violations(
    silver: DataFrame, as_of: datetime | str | None = None
) -> dict[str, DataFrame]:
    """Checks that gate Silver; each value lists violating rows."""
    return {
        "coordinates": checks.check_coordinates(silver),
        "not_null": checks.check_not_null(silver, checks.SILVER_NOT_NULL),
        "times": checks.check_times(silver, as_of),
        "unique_key": checks.check_unique(silver, READING_KEY),
    }
