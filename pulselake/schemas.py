"""Canonical schemas of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; usable before a session exists."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


TELEMETRY = _schema(
    "device_id string, region string, model string, firmware_version string, latitude double, "
    "longitude double, timestamp string, temperature double, humidity double, battery double, "
    "speed double, signal_strength int, is_online boolean, event_type string"
)

# Fields an event must carry at ingress.
REQUIRED_FIELDS = [
    "device_id",
    "latitude",
    "longitude",
    "timestamp",
    "temperature",
    "humidity",
    "battery",
    "signal_strength",
]

# One record of a topic, as a broker or a file source delivers it.
ENVELOPE = _schema(
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

RAW = _schema("record_metadata variant, record_content variant, ingested_at timestamp_ntz")

BRONZE = _schema(
    "kafka_create_time_ms bigint, kafka_offset bigint, kafka_partition int, kafka_topic string, "
    "cdc_operation string, source_table string, cdc_timestamp_ms bigint, device_id string, "
    "region string, latitude double, longitude double, temperature double, humidity double, "
    "battery double, speed double, signal_strength int, is_online boolean, event_type string, "
    "event_timestamp timestamp_ntz, ingested_at timestamp_ntz, raw_payload variant"
)

SILVER = _schema(
    "device_id string, region string, event_timestamp timestamp_ntz, event_date date, "
    "temperature double, humidity double, battery double, speed double, signal_strength int, "
    "latitude double, longitude double, is_online boolean, event_type string, "
    "cdc_operation string, source_table string, kafka_offset bigint, kafka_partition int, "
    "ingested_at timestamp_ntz, dq_status string, battery_health string, signal_quality string"
)

QUARANTINE = _schema(
    "device_id string, event_timestamp timestamp_ntz, kafka_offset bigint, kafka_partition int, "
    "rejection_reason string, original_payload variant, quarantined_at timestamp_ntz, "
    "reviewed_at timestamp_ntz, is_resolved boolean"
)

DEAD_LETTER = _schema("original_payload string, error string, failed_at timestamp_ntz")

DEVICE_REGISTRY = _schema(
    "device_id string, region string, model string, firmware_version string, "
    "registered_at timestamp_ntz, last_seen_at timestamp_ntz, is_active boolean, metadata variant"
)

EVENT_PROCESSING_LOG = _schema(
    "kafka_topic string, kafka_partition int, kafka_offset bigint, processed_at timestamp_ntz, "
    "event_count int"
)

DEVICE_ALERTS = _schema(
    "id string, device_id string, alert_type string, severity string, message string, "
    "triggered_at timestamp_ntz, resolved_at timestamp_ntz, is_resolved boolean"
)

ANOMALIES = _schema(
    "anomaly_id string, device_id string, region string, event_date date, "
    "event_timestamp timestamp_ntz, anomaly_type string, severity string, metric_value double, "
    "threshold_value double, description string, detected_at timestamp_ntz"
)

SUMMARY = _schema(
    "event_date date, device_id string, region string, total_events bigint, "
    "active_hours bigint, uptime_pct double, avg_temperature double, min_temperature double, "
    "max_temperature double, stddev_temperature double, avg_humidity double, "
    "min_humidity double, max_humidity double, battery_start_of_day double, "
    "battery_end_of_day double, battery_drain_today double, min_battery double, "
    "avg_signal_strength double, signal_excellent_count bigint, signal_good_count bigint, "
    "signal_fair_count bigint, signal_poor_count bigint, had_high_temp_alert int, "
    "had_critical_battery int, had_offline_event int, worst_battery_health string, "
    "first_event_at timestamp_ntz, last_event_at timestamp_ntz, last_updated_at timestamp_ntz, "
    "device_health_score double"
)
