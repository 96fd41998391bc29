"""Bronze: raw variants to typed readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.functions.timeutil import parse_utc

# Target column, JSON path and type.
METADATA_FIELDS = [
    ("kafka_create_time_ms", "$.CreateTime", "bigint"),
    ("kafka_offset", "$.offset", "bigint"),
    ("kafka_partition", "$.partition", "int"),
    ("kafka_topic", "$.topic", "string"),
]
CDC_FIELDS = [
    ("cdc_operation", "$.__op", "string"),
    ("source_table", "$.__table", "string"),
]
DEVICE_FIELDS = [
    ("device_id", "$.device_id", "string"),
    ("region", "$.region", "string"),
    ("latitude", "$.latitude", "double"),
    ("longitude", "$.longitude", "double"),
    ("temperature", "$.temperature", "double"),
    ("humidity", "$.humidity", "double"),
    ("battery", "$.battery", "double"),
    ("speed", "$.speed", "double"),
    ("signal_strength", "$.signal_strength", "int"),
    ("is_online", "$.is_online", "boolean"),
    ("event_type", "$.event_type", "string"),
]
KEPT_OPERATIONS = ["r", "c", "u"]


def extract(variant: str, fields: list[tuple[str, str, str]]) -> list:
    """Typed columns from JSON paths; a value that does not cast becomes NULL."""
    return [F.try_variant_get(variant, path, kind).alias(name) for name, path, kind in fields]


def has_device(variant: str = "record_content"):
    """Content is present and names a device; an explicit JSON null passes."""
    return F.col(variant).isNotNull() & F.try_variant_get(
        variant, "$.device_id", "variant"
    ).isNotNull()


def parse(raw: DataFrame) -> DataFrame:
    """Typed projection of every raw row, without filters."""
    return raw.select(
        *extract("record_metadata", METADATA_FIELDS),
        *extract("record_content", CDC_FIELDS),
        F.coalesce(
            F.try_variant_get("record_content", "$.cdc_timestamp_ms", "bigint"),
            F.try_variant_get("record_content", "$.__ts_ms", "bigint"),
        ).alias("cdc_timestamp_ms"),
        *extract("record_content", DEVICE_FIELDS),
        parse_utc(F.try_variant_get("record_content", "$.event_timestamp", "string")).alias(
            "event_timestamp"
        ),
        "ingested_at",
        F.col("record_content").alias("raw_payload"),
    )


def keep_operations(df: DataFrame, operations: list[str] = KEPT_OPERATIONS) -> DataFrame:
    """Snapshot reads, creates and updates; deletes are handled by ``apply_changes``."""
    return df.where(F.col("cdc_operation").isin(operations))


def bronze(raw: DataFrame) -> DataFrame:
    """Typed, filtered readings with the full payload kept in ``raw_payload``."""
    return keep_operations(parse(raw.where(has_device())))
