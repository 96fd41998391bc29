"""Topic sources: telemetry, change stream and raw landing.

A broker is read with the Kafka connector of the cluster; that connector is not part of this
environment, so the Kafka branch is thin and only the file form is tested. The file form reads
the same envelope (key, value, topic, partition, offset, timestamp) from Parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.schemas import ENVELOPE


def read_envelope(
    spark: SparkSession,
    source: str,
    streaming: bool = False,
    bootstrap: str | None = None,
    max_records: int | None = None,
    max_files: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Records of a topic (``bootstrap`` given: topic name, else a folder of files)."""
    reader = spark.readStream if streaming else spark.read
    if bootstrap is None:
        if streaming and max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.schema(ENVELOPE).parquet(source)
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", source)
        .option("startingOffsets", "earliest")
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_telemetry(spark: SparkSession, source: str, streaming: bool = False, **options) -> DataFrame:
    """Telemetry records with ``payload`` parsed; ``payload`` is NULL for malformed JSON."""
    return read_envelope(spark, source, streaming, **options).withColumn(
        "payload", F.try_parse_json("value")
    )


def read_cdc(spark: SparkSession, source: str, streaming: bool = False, **options) -> DataFrame:
    """Change records: parsed after-image with operation, source table and change time.

    The initial snapshot of a table carries operation ``r``; tombstones have a NULL payload.
    """
    text = {"op": "$.__op", "source_table": "$.__table"}
    return read_telemetry(spark, source, streaming, **options).select(
        "*",
        *(F.try_variant_get("payload", p, "string").alias(n) for n, p in text.items()),
        F.coalesce(
            F.try_variant_get("payload", "$.cdc_timestamp_ms", "bigint"),
            F.try_variant_get("payload", "$.__ts_ms", "bigint"),
        ).alias("cdc_timestamp_ms"),
    )


def to_raw(envelope: DataFrame) -> DataFrame:
    """Topic records as raw landing rows; malformed JSON keeps a NULL content."""
    metadata = F.to_json(
        F.struct(
            F.unix_millis("timestamp").alias("CreateTime"), "offset", "partition", "topic"
        )
    )
    return envelope.select(
        F.parse_json(metadata).alias("record_metadata"),
        F.try_parse_json("value").alias("record_content"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"),
    )
