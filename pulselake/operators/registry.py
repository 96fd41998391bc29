"""Device registry: seed rows and upkeep from telemetry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.config import instant
from pulselake.schemas import DEVICE_REGISTRY
from pulselake.sources.derived import MODELS, REGIONS


def registry_rows(numbers: DataFrame, number: str, as_of: datetime | str | None = None) -> DataFrame:
    """Registry row of each device number: padded id, region and model by remainder, firmware."""
    n = F.col(number)

    def choose(options: list[str]):
        return F.element_at(F.array(*map(F.lit, options)), (n % len(options) + 1).cast("int"))

    text = n.cast("string")
    # LPAD cuts longer text, so numbers of more than four digits keep their own width.
    padded = F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)
    return numbers.select(
        F.concat(F.lit("device_"), padded).alias("device_id"),
        choose(REGIONS).alias("region"),
        choose(MODELS).alias("model"),
        F.concat(F.lit("v"), n % 3 + 1, F.lit("."), n % 10, F.lit(".0")).alias("firmware_version"),
        instant(as_of).alias("registered_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_seen_at"),
        F.lit(True).alias("is_active"),
        F.parse_json(F.lit("{}")).alias("metadata"),
    ).select(*DEVICE_REGISTRY.fieldNames())


def seed_registry(spark: SparkSession, n: int = 100, as_of: datetime | str | None = None) -> DataFrame:
    """Registry of devices 1 to n; insert it with ``insert_absent``."""
    return registry_rows(spark.range(1, n + 1), "id", as_of)


ATTRIBUTES = ["region", "model", "firmware_version"]


def observed_devices(telemetry: DataFrame) -> DataFrame:
    """Newest attributes and last event time of each device; ties go to the higher offset.

    Readings are first reduced to one row per device and attribute combination with a
    fixed-width order value, which keeps the large step in hash aggregation.
    """
    micros = F.unix_micros(F.col("event_timestamp").cast("timestamp")).cast("decimal(19,0)")
    order = micros * F.lit(10**18).cast("decimal(19,0)") + F.col("kafka_offset")
    return (
        telemetry.where(F.col("device_id").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("device_id", *ATTRIBUTES)
        .agg(F.max(order).alias("_order"), F.max("event_timestamp").alias("_seen"))
        .groupBy("device_id")
        .agg(
            F.max_by(F.struct(*ATTRIBUTES), "_order").alias("_n"),
            F.max("_seen").alias("last_seen_at"),
        )
        .select("device_id", "_n.*", "last_seen_at")
    )


def refresh_registry(registry: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Registry with attributes and ``last_seen_at`` taken from newer telemetry.

    Devices that are not registered are left out; registration is a separate step.
    """
    seen = observed_devices(telemetry)
    r, o = registry.alias("r"), seen.alias("o")
    newer = F.col("o.last_seen_at").isNotNull() & F.coalesce(
        F.col("o.last_seen_at") >= F.col("r.last_seen_at"), F.lit(True)
    )

    def pick(name: str):
        return F.when(newer, F.coalesce(f"o.{name}", f"r.{name}")).otherwise(F.col(f"r.{name}"))

    updated = [*ATTRIBUTES, "last_seen_at"]
    return r.join(o, F.col("r.device_id") == F.col("o.device_id"), "left").select(
        *(pick(c).alias(c) if c in updated else F.col(f"r.{c}") for c in registry.columns)
    )
