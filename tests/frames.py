"""Hand-written frames for unit tests."""

from datetime import datetime

from pyspark.sql import functions as F

from pulselake.schemas import SILVER

READING = {
    "device_id": "device_0001",
    "region": "miami",
    "latitude": 10.0,
    "longitude": 20.0,
    "temperature": 20.0,
    "humidity": 50.0,
    "battery": 90.0,
    "speed": 1.0,
    "signal_strength": -40,
    "is_online": True,
    "event_type": "telemetry",
    "event_timestamp": "2024-01-10 12:00:00",
    "ingested_at": "2024-01-10 12:01:00",
    "cdc_operation": "c",
    "source_table": "iot_events",
    "cdc_timestamp_ms": 1,
    "kafka_offset": 1,
    "kafka_partition": 0,
    "kafka_topic": "device-changes",
}
TYPES = {
    "signal_strength": "int",
    "is_online": "boolean",
    "event_timestamp": "string",
    "ingested_at": "string",
    "cdc_timestamp_ms": "bigint",
    "kafka_offset": "bigint",
    "kafka_partition": "int",
}
DOUBLES = {"latitude", "longitude", "temperature", "humidity", "battery", "speed"}


def readings(spark, *changes: dict):
    """Bronze-shaped rows: the default reading with each set of changes applied."""
    rows = [tuple({**READING, **c}.values()) for c in changes]
    kinds = ", ".join(
        f"{n} {'double' if n in DOUBLES else TYPES.get(n, 'string')}" for n in READING
    )
    return (
        spark.createDataFrame(rows, kinds)
        .withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
        .withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))
    )


def silver_rows(spark, *changes: dict):
    from pulselake.operators.silver import silver_columns

    return silver_columns(readings(spark, *changes).withColumn("dq_status", F.lit("VALID")))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    return sorted(
        (tuple(r) for r in df.select(*columns).collect()),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def same(left, right) -> bool:
    columns = sorted(left.columns)
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


assert set(SILVER.fieldNames()) - set(READING) == {
    "event_date",
    "dq_status",
    "battery_health",
    "signal_quality",
}
