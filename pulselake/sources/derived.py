"""Telemetry derived from the ``events`` table of the test data.

Every event becomes one change-stream record of a device reading; each tenth reading is later
corrected by an update with a higher offset. The mapping is integer arithmetic only, so the
SQL oracle states it in the same words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Regions and models in registry order.
REGIONS = ["new_york", "los_angeles", "chicago", "houston", "miami"]
MODELS = ["TempSensor-Pro", "HumidBot-v2", "FleetTracker-X"]

# One formula per column over id, n (device number), bump (0 original,
# 1 correction) and ts.
FORMULAS = {
    "kafka_create_time_ms": "unix_millis(cast(ts AS timestamp))",
    "kafka_offset": "id * 2 + bump",
    "kafka_partition": "cast(n % 6 AS int)",
    "kafka_topic": "'device-changes'",
    "cdc_operation": "CASE WHEN bump = 1 THEN 'u' WHEN id % 29 = 0 THEN 'd' "
    "WHEN id % 7 = 0 THEN 'r' ELSE 'c' END",
    "source_table": "CASE WHEN id % 23 = 0 THEN 'device_registry' "
    "WHEN id % 41 = 0 THEN 'device_alerts' ELSE 'iot_events' END",
    "cdc_timestamp_ms": "unix_millis(cast(ts AS timestamp)) + 500 + bump",
    "device_id": "CASE WHEN id % 199 = 0 THEN NULL "
    "ELSE concat('device_', lpad(cast(n AS string), 4, '0')) END",
    "region": "element_at(array('new_york', 'los_angeles', 'chicago', 'houston', 'miami'), "
    "cast(n % 5 AS int) + 1)",
    "model": "element_at(array('TempSensor-Pro', 'HumidBot-v2', 'FleetTracker-X'), "
    "cast(n % 3 AS int) + 1)",
    "firmware_version": "concat('v', 1 + n % 3, '.', id % 10, '.0')",
    "latitude": "CASE WHEN id % 173 = 0 THEN NULL WHEN id % 163 = 0 THEN 95.5D "
    "ELSE 30 + cast(id % 1000 AS double) / 100 END",
    "longitude": "CASE WHEN id % 179 = 0 THEN NULL WHEN id % 167 = 0 THEN -181D "
    "ELSE -100 + cast(id % 2000 AS double) / 100 END",
    "temperature": "CASE WHEN id % 113 = 0 THEN NULL WHEN id % 97 = 0 THEN 95D "
    "WHEN id % 211 = 0 THEN 75D ELSE cast((id * 7919) % 400 AS double) / 10 + bump END",
    "humidity": "CASE WHEN id % 139 = 0 THEN NULL WHEN id % 131 = 0 THEN 150D "
    "ELSE cast((id * 31) % 1000 AS double) / 10 END",
    "battery": "CASE WHEN id % 157 = 0 THEN -5D WHEN id % 149 = 0 THEN 20D "
    "ELSE cast(1000 - (id * 17) % 980 AS double) / 10 END",
    "speed": "cast((id * 37) % 1200 AS double) / 10",
    "signal_strength": "cast(-(30 + (id * 13) % 71) AS int)",
    "is_online": "id % 50 <> 0",
    "event_type": "event_type",
    "event_timestamp": "CASE WHEN id % 181 = 0 THEN NULL "
    "WHEN id % 191 = 0 THEN TIMESTAMP_NTZ'2099-01-01 00:00:00' "
    "WHEN id % 193 = 0 THEN TIMESTAMP_NTZ'2019-12-31 00:00:00' ELSE ts END",
    "ingested_at": "ts + INTERVAL '60' SECOND",
}

META_FIELDS = ["kafka_create_time_ms", "kafka_offset", "kafka_partition", "kafka_topic"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed change-stream records: originals plus corrections, from one scan of ``events``."""
    versions = F.when(F.col("id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return (
        events(spark, sf_dir)
        .select(
            F.col("event_id").alias("id"),
            (F.col("user_id") % 20 + 1).alias("n"),
            "ts",
            "event_type",
        )
        .withColumn("bump", F.explode(versions))
        .selectExpr(*(f"{formula} AS {name}" for name, formula in FORMULAS.items()))
    )


def payload_text(df: DataFrame) -> DataFrame:
    """Adds ``payload``: the reading as JSON text, with an explicit null for a NULL device."""
    renamed = [
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.col("cdc_operation").alias("__op"),
        F.col("source_table").alias("__table"),
        F.col("cdc_timestamp_ms").alias("__ts_ms"),
    ]
    taken = {"device_id", "event_timestamp", "ingested_at", "cdc_operation", "source_table"}
    taken |= {"cdc_timestamp_ms", *META_FIELDS}
    others = [c for c in df.columns if c not in taken]
    device = F.coalesce(F.concat(F.lit('"'), "device_id", F.lit('"')), F.lit("null"))
    return (
        df.withColumn("_rest", F.to_json(F.struct(*renamed, *others)))
        .withColumn(
            "payload",
            F.concat(F.lit('{"device_id":'), device, F.lit(","), F.expr("substring(_rest, 2)")),
        )
        .drop("_rest")
    )


def raw_landing(df: DataFrame) -> DataFrame:
    """Telemetry as raw landing rows: two variants and the ingest time.

    The generator keeps later filters on the content above the step that builds and parses the
    JSON; pushed below it, they would repeat that step for every field they name.
    """
    meta = F.to_json(
        F.struct(
            F.col("kafka_create_time_ms").alias("CreateTime"),
            F.col("kafka_offset").alias("offset"),
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_topic").alias("topic"),
        )
    )
    return payload_text(df).select(
        F.parse_json(meta).alias("record_metadata"),
        F.explode(F.array(F.parse_json("payload"))).alias("record_content"),
        "ingested_at",
    )


def change_topic(df: DataFrame) -> DataFrame:
    """Telemetry as topic records (the schema of a broker source)."""
    return payload_text(df).select(
        F.col("device_id").alias("key"),
        F.col("payload").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.timestamp_millis("kafka_create_time_ms").alias("timestamp"),
    )


def published(df: DataFrame, *carry: str) -> DataFrame:
    """Telemetry in the device's own schema, with ISO-8601 UTC text as ``timestamp``.

    ``carry`` names columns of the transport to keep, such as the offset.
    """
    return df.select(
        "device_id",
        "region",
        "model",
        "firmware_version",
        "latitude",
        "longitude",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        "temperature",
        "humidity",
        "battery",
        "speed",
        "signal_strength",
        "is_online",
        "event_type",
        *carry,
    )
