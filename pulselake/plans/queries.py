"""Registered queries: one per inventory row, each with its reference SQL where SQL can say it.

Bronze, quality and Silver queries run from the ``events`` table. Queries on Gold read the
Silver, quarantine, summary and anomaly tables, which ``lake_for`` builds once per session and
data folder with the batch flow, as a deployment would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.config import Config, ago, instant
from pulselake.functions.numeric import millionths
from pulselake.functions.quality import (
    battery_health,
    ingress_error,
    quality_status,
    signal_quality,
)
from pulselake.functions.timeutil import minutes_crossed, parse_utc, truncate
from pulselake.operators import alerts, checks, measures, panels, registry, serving
from pulselake.operators.anomalies import anomalies as find_anomalies
from pulselake.operators.anomalies import (
    device_days,
    events_with_stats,
    newest_first,
    rolling_stats,
    with_lag,
)
from pulselake.operators.bronze import CDC_FIELDS, DEVICE_FIELDS, METADATA_FIELDS
from pulselake.operators.bronze import bronze as parse_bronze
from pulselake.operators.bronze import extract, has_device, keep_operations
from pulselake.operators.cdc import apply_changes, rename_change_time, route, unwrap_cdc
from pulselake.operators.dedup import READING_KEY, change_order, keep_latest
from pulselake.operators.incremental import (
    incremental,
    insert_absent,
    processing_log,
    skip_processed,
)
from pulselake.operators.notices import Route, repeat_suppressed
from pulselake.operators.offsets import offset_ranges, unseen, whole_ranges
from pulselake.operators.silver import classify, silver, silver_columns, split_valid
from pulselake.operators.summary import GRAIN, device_summary
from pulselake.operators.timeline import hot_days
from pulselake.operators.upsert import merge, newest_per_key, upsert
from pulselake.plans.medallion import Lake, load_silver, refresh_step, run
from pulselake.plans.oracle import (
    AS_OF,
    LOADED_UNTIL,
    SERVED_AT,
    key,
    mean,
    plain_mean,
    stamp,
    statement,
)
from pulselake.schemas import ANOMALIES, SILVER, SUMMARY, TELEMETRY
from pulselake.session import prepare, scratch_path
from pulselake.sinks.archive import dead_letter_path, with_hour_parts, write_archive
from pulselake.sinks.dead_letter import split_dead_letters
from pulselake.sinks.measures import ensure_table, write_measures
from pulselake.sinks.relational import relational_rows, upsert_relational
from pulselake.sinks.tables import (
    align_schema,
    expired_partitions,
    rebuild,
    retention_filter,
    storage_tier,
    write_partitioned,
)
from pulselake.sinks.versions import read_newest
from pulselake.sources.archive import read_archive
from pulselake.sources.derived import change_topic, published, raw_landing, telemetry
from pulselake.sources.tables import read_snapshot, scan
from pulselake.sources.topics import read_cdc, read_envelope, read_telemetry
from pulselake.streaming import aggregates, jobs, replay
from pulselake.streaming.notices import notice_step

Query = Callable[[SparkSession, str], DataFrame]

CFG = Config()
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_LAKES: dict[tuple[str, str], Lake] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when SQL can state it, its reference statement."""

    def register(body: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return body(prepare(spark), sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = statement(sql)
        return body

    return register


def build_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Every layer from raw landing to Gold, below the shared folder."""
    lake = Lake(scratch_path(spark, "lake"))
    raw_landing(telemetry(spark, sf_dir)).write.parquet(lake.raw)
    run(lake.read_raw(spark), lake, CFG, AS_OF)
    return lake


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _LAKES:
        _LAKES[slot] = build_lake(spark, sf_dir)
    return _LAKES[slot]


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_for(spark, sf_dir).read_silver(spark)


def quarantine_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_for(spark, sf_dir).read_quarantine(spark)


def summary_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_for(spark, sf_dir).read_summary(spark)


def anomalies_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_for(spark, sf_dir).read_anomalies(spark)


def readings_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed Bronze readings, straight from the events table."""
    return keep_operations(telemetry(spark, sf_dir))


def stream_files(spark: SparkSession) -> int:
    """Files to write for a stream: enough for every core, so each batch runs in parallel."""
    return max(4, spark.sparkContext.defaultParallelism)


def half(spark: SparkSession) -> int:
    """Files per batch that make a stream of ``stream_files`` run in two batches."""
    return stream_files(spark) // 2


def topic_files(spark: SparkSession, records: DataFrame) -> str:
    """Topic records written as files, for the file form of the topic sources."""
    path = scratch_path(spark, "topic")
    records.repartition(stream_files(spark), "partition", "offset").write.parquet(path)
    return path


def drained(*running) -> None:
    """Wait for scheduled (available-now) streaming runs to finish."""
    for q in running:
        q.awaitTermination()


# ---------------------------------------------------------------- A. Sources

DEVICE_LIST = "device_id, region, latitude, longitude, temperature, humidity, battery, speed, signal_strength, is_online, event_type"
POSITION = "kafka_topic, kafka_partition, kafka_offset"


@query(
    "a1_telemetry_topic",
    f"SELECT kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS \"offset\", {DEVICE_LIST} FROM telemetry",
)
def a1(spark, sf):
    path = topic_files(spark, change_topic(telemetry(spark, sf)))
    return read_telemetry(spark, path).select(
        "topic", "partition", "offset", *extract("payload", DEVICE_FIELDS)
    )


@query(
    "a2_cdc_topic",
    'SELECT kafka_partition AS partition, kafka_offset AS "offset", cdc_operation AS op, source_table, cdc_timestamp_ms FROM telemetry',
)
def a2(spark, sf):
    path = topic_files(spark, change_topic(telemetry(spark, sf)))
    return read_cdc(spark, path).select("partition", "offset", "op", "source_table", "cdc_timestamp_ms")


@query(
    "a3_raw_landing",
    f"SELECT {POSITION}, kafka_create_time_ms, device_id, temperature, event_timestamp FROM telemetry "
    "WHERE cdc_operation IN ('r', 'c', 'u')",
)
def a3(spark, sf):
    source = topic_files(spark, change_topic(telemetry(spark, sf)))
    target, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    drained(jobs.start_landing(spark, source, target, checkpoint, jobs.ONCE, max_files=half(spark)))
    return parse_bronze(spark.read.parquet(target)).select(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_create_time_ms",
        "device_id",
        "temperature",
        "event_timestamp",
    )


@query("a4_table_snapshot", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a4(spark, sf):
    return read_snapshot(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


@query(
    "a5_table_scan",
    "SELECT device_id, event_timestamp, battery FROM silver WHERE event_date = DATE '2024-01-15' AND region = 'chicago'",
)
def a5(spark, sf):
    return scan(
        silver_of(spark, sf),
        ["device_id", "event_timestamp", "battery"],
        F.col("event_date") == F.lit("2024-01-15").cast("date"),
        F.col("region") == "chicago",
    )


@query(
    "a6_archive_replay",
    f"SELECT {DEVICE_LIST}, model, firmware_version, event_timestamp FROM bronze "
    "WHERE event_timestamp >= TIMESTAMP '2024-01-10 06:00:00' AND event_timestamp < TIMESTAMP '2024-01-12 19:00:00'",
)
def a6(spark, sf):
    path = scratch_path(spark, "archive")
    write_archive(published(readings_of(spark, sf)), path)
    replay = read_archive(spark, path, "2024-01-10 06:30:00", "2024-01-12 18:15:00")
    return replay.select(
        *(c.strip() for c in DEVICE_LIST.split(",")),
        "model",
        "firmware_version",
        parse_utc(F.col("timestamp")).alias("event_timestamp"),
    )


# ------------------------------------------- B. Sinks and materializations

HOUR_FOLDERS = """SELECT CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month,
  CAST(day(event_timestamp) AS INTEGER) AS day, CAST(hour(event_timestamp) AS INTEGER) AS hour, COUNT(*) AS events
FROM bronze GROUP BY 1, 2, 3, 4"""


def _archived_events(spark, path):
    """Events per hour folder; those in the dead letters have no hour."""
    parts = ["year", "month", "day", "hour"]
    archived = read_archive(spark, path).select(*parts)
    unplaced = spark.read.parquet(dead_letter_path(path)).select(
        *(F.lit(None).cast("int").alias(part) for part in parts)
    )
    return archived.unionByName(unplaced).groupBy(*parts).agg(F.count("*").alias("events"))


@query("b1_hourly_archive", HOUR_FOLDERS)
def b1(spark, sf):
    path = scratch_path(spark, "archive")
    write_archive(published(readings_of(spark, sf)), path)
    return _archived_events(spark, path)


RELATIONAL_FIELDS = f"{DEVICE_LIST}, event_timestamp"


@query(
    "b2_relational_upsert",
    f"""SELECT {RELATIONAL_FIELDS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, event_timestamp
  ORDER BY kafka_offset DESC) AS pick FROM bronze) AS ordered WHERE pick = 1 AND event_timestamp IS NOT NULL""",
)
def b2(spark, sf):
    order = ["kafka_offset"]

    def batch(condition: str) -> DataFrame:
        source = readings_of(spark, sf).where(condition)
        return relational_rows(published(source, *order), AS_OF, order)

    path = scratch_path(spark, "relational")
    upsert_relational(batch("kafka_offset % 2 = 0"), path, order)
    upsert_relational(batch("kafka_offset % 2 = 1"), path, order)
    return spark.read.parquet(path).drop("event_date", "ingested_at", *order)


@query(
    "b3_relational_fields",
    f"SELECT {RELATIONAL_FIELDS}, TIMESTAMP '{AS_OF}' AS ingested_at FROM telemetry",
)
def b3(spark, sf):
    return relational_rows(published(telemetry(spark, sf)), AS_OF)


INGRESS_SQL = """CASE
  WHEN missing <> '' THEN 'Missing fields: ' || missing
  WHEN latitude NOT BETWEEN -90 AND 90 THEN 'Invalid latitude: ' || CAST(latitude AS VARCHAR)
  WHEN longitude NOT BETWEEN -180 AND 180 THEN 'Invalid longitude: ' || CAST(longitude AS VARCHAR)
  WHEN temperature NOT BETWEEN -50 AND 80 THEN 'Temperature out of sensor range: ' || CAST(temperature AS VARCHAR)
  WHEN humidity NOT BETWEEN 0 AND 100 THEN 'Humidity out of range: ' || CAST(humidity AS VARCHAR) END"""
MISSING_SQL = """concat_ws(', ', CASE WHEN battery IS NULL THEN 'battery' END, CASE WHEN device_id IS NULL THEN 'device_id' END,
  CASE WHEN humidity IS NULL THEN 'humidity' END, CASE WHEN latitude IS NULL THEN 'latitude' END,
  CASE WHEN longitude IS NULL THEN 'longitude' END, CASE WHEN signal_strength IS NULL THEN 'signal_strength' END,
  CASE WHEN temperature IS NULL THEN 'temperature' END, CASE WHEN event_timestamp IS NULL THEN 'timestamp' END)"""


def _published_topic(spark, sf):
    """Published events as a topic; NULL fields are absent from the JSON."""
    source = telemetry(spark, sf)
    text = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    fields = [c for c in TELEMETRY.fieldNames() if c != "timestamp"]
    return source.withColumn("timestamp", text).select(
        F.col("device_id").alias("key"),
        F.to_json(F.struct(*fields, "timestamp")).alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.timestamp_millis("kafka_create_time_ms").alias("timestamp"),
    )


@query(
    "b5_dead_letters",
    f"""SELECT partition, "offset", error, failed_at FROM (
  SELECT kafka_partition AS partition, kafka_offset AS "offset", {INGRESS_SQL} AS error,
    TIMESTAMP '{AS_OF}' AS failed_at
  FROM (SELECT *, {MISSING_SQL} AS missing FROM telemetry) AS listed) AS judged WHERE error IS NOT NULL""",
)
def b5(spark, sf):
    path = topic_files(spark, _published_topic(spark, sf))
    _, rejected = split_dead_letters(read_envelope(spark, path), CFG, AS_OF)
    return rejected.select("partition", "offset", "error", "failed_at")


@query("b6_bronze_view", f"SELECT {POSITION}, device_id, event_timestamp, temperature FROM bronze")
def b6(spark, sf):
    parse_bronze(_raw(spark, sf)).createOrReplaceTempView("bronze_readings")
    return spark.table("bronze_readings").select(
        *(c.strip() for c in POSITION.split(",")), "device_id", "event_timestamp", "temperature"
    )


SILVER_LIST = ", ".join(SILVER.fieldNames())


@query("b7_incremental_silver", f"SELECT {SILVER_LIST} FROM silver")
def b7(spark, sf):
    """Two incremental loads give the same table as one load of everything."""
    lake = Lake(scratch_path(spark, "lake"))
    readings = readings_of(spark, sf)
    first = readings.where(F.col("ingested_at") <= instant(LOADED_UNTIL))
    load_silver(first, lake, CFG, AS_OF)
    rest = incremental(readings, lake.read_silver(spark), "ingested_at")
    load_silver(rest, lake, CFG, AS_OF)
    return lake.read_silver(spark)


@query(
    "b8_gold_rebuild",
    "SELECT event_date, device_id, region, total_events, device_health_score FROM summary",
)
def b8(spark, sf):
    path = scratch_path(spark, "gold")
    rebuild(summary_of(spark, sf), path, "event_date", ["region"])
    rebuild(device_summary(silver_of(spark, sf)), path, "event_date", ["region"])
    return spark.read.parquet(path).select(
        "event_date", "device_id", "region", "total_events", "device_health_score"
    )


@query(
    "b9_clustered_layout",
    "SELECT device_id, region, anomaly_type, event_timestamp FROM anomalies "
    "WHERE event_date = DATE '2024-01-12' AND anomaly_type = 'SIGNAL_LOST'",
)
def b9(spark, sf):
    path = scratch_path(spark, "clustered")
    write_partitioned(anomalies_of(spark, sf), path, "event_date", ["anomaly_type"])
    return (
        spark.read.parquet(path)
        .where("event_date = DATE'2024-01-12' AND anomaly_type = 'SIGNAL_LOST'")
        .select("device_id", "region", "anomaly_type", "event_timestamp")
    )


@query(
    "b10_schema_sync",
    f"""SELECT device_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date, temperature,
  CASE WHEN kafka_offset % 2 = 1 THEN model END AS model FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, event_timestamp ORDER BY kafka_offset DESC) AS pick
  FROM bronze WHERE event_timestamp IS NOT NULL) AS ordered WHERE pick = 1""",
)
def b10(spark, sf):
    """The second load adds a column and drops one; older rows get NULL for the new column."""
    base = readings_of(spark, sf).where("event_timestamp IS NOT NULL")
    newest = keep_latest(base, READING_KEY, [F.desc("kafka_offset")])
    dated = newest.withColumn("event_date", F.to_date("event_timestamp"))
    shared = ["device_id", "event_timestamp", "event_date", "temperature"]
    old = dated.where("kafka_offset % 2 = 0").select(*shared, "humidity")
    new = dated.where("kafka_offset % 2 = 1").select(*shared, "model")
    path = scratch_path(spark, "evolving")
    upsert(old, path, READING_KEY, "event_date")
    upsert(new, path, READING_KEY, "event_date")
    return align_schema(spark.read.schema(new.schema).parquet(path), new.schema)


@query(
    "b11_measure_export",
    "SELECT measure_name, COUNT(*) AS measures FROM (SELECT measure_name FROM long_telemetry "
    "UNION ALL SELECT measure_name FROM long_health) AS exported GROUP BY measure_name",
)
def b11(spark, sf):
    rows = summary_of(spark, sf)
    when = F.col("last_updated_at")
    path = scratch_path(spark, "measures")
    ensure_table(measures.telemetry_measures(rows, when), path)
    write_measures(measures.telemetry_measures(rows, when), path)
    write_measures(measures.health_measures(rows, when), path)
    return spark.read.parquet(path).groupBy("measure_name").agg(F.count("*").alias("measures"))


@query(
    "b12_retention",
    f"SELECT device_id, event_timestamp FROM silver WHERE event_timestamp >= TIMESTAMP '{SERVED_AT}' - INTERVAL '7' DAY",
)
def b12(spark, sf):
    kept = retention_filter(silver_of(spark, sf), "event_timestamp", 7, SERVED_AT)
    return kept.select("device_id", "event_timestamp")


@query(
    "b12_expired_partitions",
    f"SELECT event_date, COUNT(*) AS row_count FROM silver WHERE event_date < CAST(TIMESTAMP '{SERVED_AT}' AS DATE) - 7 GROUP BY event_date",
)
def b12_expired(spark, sf):
    return expired_partitions(silver_of(spark, sf), "event_date", 7, SERVED_AT)


@query(
    "b13_storage_tier",
    """SELECT event_date, CASE WHEN DATE '2025-01-15' - event_date >= 365 THEN 'archive'
  WHEN DATE '2025-01-15' - event_date >= 90 THEN 'infrequent' ELSE 'standard' END AS tier, COUNT(*) AS row_count
FROM silver GROUP BY event_date""",
)
def b13(spark, sf):
    tier = storage_tier("event_date", "2025-01-15 00:00:00").alias("tier")
    return silver_of(spark, sf).groupBy("event_date", tier).agg(F.count("*").alias("row_count"))


# --------------------------------------------- C. Bronze: parse, normalise


def _raw(spark, sf):
    return lake_for(spark, sf).read_raw(spark)


OFFSETS = "kafka_partition, kafka_offset"


@query("c1_metadata_fields", f"SELECT kafka_create_time_ms, {POSITION} FROM telemetry")
def c1(spark, sf):
    return _raw(spark, sf).select(*extract("record_metadata", METADATA_FIELDS))


@query(
    "c2_cdc_fields",
    f"SELECT {OFFSETS}, cdc_operation, source_table, cdc_timestamp_ms FROM bronze",
)
def c2(spark, sf):
    return parse_bronze(_raw(spark, sf)).select(
        "kafka_partition", "kafka_offset", *(n for n, _, _ in CDC_FIELDS), "cdc_timestamp_ms"
    )


@query("c3_device_fields", f"SELECT {OFFSETS}, {DEVICE_LIST} FROM bronze")
def c3(spark, sf):
    return parse_bronze(_raw(spark, sf)).select(
        "kafka_partition", "kafka_offset", *(n for n, _, _ in DEVICE_FIELDS)
    )


@query("c4_event_time", f"SELECT {OFFSETS}, event_timestamp FROM bronze")
def c4(spark, sf):
    return parse_bronze(_raw(spark, sf)).select("kafka_partition", "kafka_offset", "event_timestamp")


@query(
    "c5_drop_tombstones",
    f"SELECT {OFFSETS}, device_id FROM telemetry WHERE cdc_operation <> 'd'",
)
def c5(spark, sf):
    """Deletes become tombstones (no content) here; explicit JSON null devices stay."""
    raw = _raw(spark, sf).withColumn(
        "record_content",
        F.when(
            F.try_variant_get("record_content", "$.__op", "string") != "d", F.col("record_content")
        ),
    )
    return raw.where(has_device()).select(
        F.try_variant_get("record_metadata", "$.partition", "int").alias("kafka_partition"),
        F.try_variant_get("record_metadata", "$.offset", "bigint").alias("kafka_offset"),
        F.try_variant_get("record_content", "$.device_id", "string").alias("device_id"),
    )


@query(
    "c6_operation_filter",
    "SELECT cdc_operation, COUNT(*) AS changes FROM telemetry WHERE cdc_operation IN ('r', 'c', 'u') GROUP BY cdc_operation",
)
def c6(spark, sf):
    kept = keep_operations(telemetry(spark, sf))
    return kept.groupBy("cdc_operation").agg(F.count("*").alias("changes"))


@query("c7_payload_kept", f"SELECT {OFFSETS}, model, firmware_version FROM bronze")
def c7(spark, sf):
    """Fields that are not projected remain readable in the carried payload."""
    return parse_bronze(_raw(spark, sf)).select(
        "kafka_partition",
        "kafka_offset",
        F.try_variant_get("raw_payload", "$.model", "string").alias("model"),
        F.try_variant_get("raw_payload", "$.firmware_version", "string").alias("firmware_version"),
    )


def _envelopes(spark, sf):
    """Change envelopes before unwrapping: a delete has only its before-image."""
    source = telemetry(spark, sf)
    image = F.struct("device_id", "temperature", "battery", "event_timestamp")
    deleted = F.col("cdc_operation") == "d"
    return source.select(
        "kafka_partition",
        "kafka_offset",
        F.when(deleted | (F.col("cdc_operation") == "u"), image).alias("before"),
        F.when(~deleted, image).alias("after"),
        F.col("cdc_operation").alias("op"),
        F.struct(F.col("source_table").alias("table")).alias("source"),
        F.col("cdc_timestamp_ms").alias("ts_ms"),
    )


@query(
    "c8_unwrap_envelope",
    f"""SELECT {OFFSETS}, device_id, temperature, battery, event_timestamp, cdc_operation AS __op,
  source_table AS __table, cdc_timestamp_ms AS __ts_ms, cdc_operation = 'd' AS __deleted FROM telemetry""",
)
def c8(spark, sf):
    return unwrap_cdc(_envelopes(spark, sf))


@query("c9_rename_change_time", f"SELECT {OFFSETS}, cdc_timestamp_ms FROM telemetry")
def c9(spark, sf):
    return rename_change_time(unwrap_cdc(_envelopes(spark, sf))).select(
        "kafka_partition", "kafka_offset", "cdc_timestamp_ms"
    )


@query(
    "c10_apply_changes",
    f"""SELECT {OFFSETS}, device_id, event_timestamp, cdc_operation FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, event_timestamp
    ORDER BY kafka_offset DESC, cdc_timestamp_ms DESC, kafka_partition DESC) AS pick FROM telemetry) AS ordered
WHERE pick = 1 AND cdc_operation <> 'd'""",
)
def c10(spark, sf):
    return apply_changes(telemetry(spark, sf), READING_KEY, change_order()).select(
        "kafka_partition", "kafka_offset", "device_id", "event_timestamp", "cdc_operation"
    )


@query(
    "c11_route_by_table",
    f"SELECT {OFFSETS}, device_id, source_table FROM telemetry WHERE source_table = 'device_registry'",
)
def c11(spark, sf):
    return route(telemetry(spark, sf), "device_registry").select(
        "kafka_partition", "kafka_offset", "device_id", "source_table"
    )


# ------------------------------------------------------- D. Data quality


@query(
    "d1_ingress_validation",
    f"SELECT {OFFSETS}, {INGRESS_SQL} AS error FROM (SELECT *, {MISSING_SQL} AS missing FROM telemetry) AS listed",
)
def d1(spark, sf):
    checked = telemetry(spark, sf).withColumn("timestamp", F.col("event_timestamp"))
    return checked.select("kafka_partition", "kafka_offset", ingress_error(CFG).alias("error"))


@query("d2_quality_status", f"SELECT {OFFSETS}, device_id, event_timestamp, dq_status FROM classified")
def d2(spark, sf):
    return classify(readings_of(spark, sf), CFG, AS_OF).select(
        "kafka_partition", "kafka_offset", "device_id", "event_timestamp", "dq_status"
    )


@query(
    "d3_valid_invalid_split",
    "SELECT 'valid' AS part, COUNT(*) AS readings FROM silver UNION ALL SELECT 'invalid', COUNT(*) FROM quarantine",
)
def d3(spark, sf):
    parts = split_valid(classify(readings_of(spark, sf), CFG, AS_OF))
    counted = [
        part.agg(F.count("*").alias("readings")).select(F.lit(name).alias("part"), "readings")
        for name, part in zip(("valid", "invalid"), parts)
    ]
    return counted[0].unionByName(counted[1])


@query(
    "d4_quarantine",
    f"SELECT device_id, event_timestamp, {OFFSETS}, rejection_reason, quarantined_at, reviewed_at, is_resolved FROM quarantine",
)
def d4(spark, sf):
    return quarantine_of(spark, sf).select(
        "device_id",
        "event_timestamp",
        "kafka_partition",
        "kafka_offset",
        "rejection_reason",
        "quarantined_at",
        "reviewed_at",
        "is_resolved",
    )


@query(
    "d5_battery_health",
    f"SELECT {OFFSETS}, battery, CASE WHEN battery < 10 THEN 'critical' WHEN battery < 20 THEN 'warning' ELSE 'healthy' END AS battery_health FROM telemetry",
)
def d5(spark, sf):
    return telemetry(spark, sf).select(
        "kafka_partition", "kafka_offset", "battery", battery_health(CFG).alias("battery_health")
    )


@query(
    "d6_signal_quality",
    f"""SELECT {OFFSETS}, signal_strength, CASE WHEN signal_strength > -50 THEN 'excellent' WHEN signal_strength > -70 THEN 'good'
  WHEN signal_strength > -85 THEN 'fair' ELSE 'poor' END AS signal_quality FROM telemetry""",
)
def d6(spark, sf):
    return telemetry(spark, sf).select(
        "kafka_partition", "kafka_offset", "signal_strength", signal_quality().alias("signal_quality")
    )


# ------------------------------------ E. Silver: dedup, incremental, upsert


@query("e1_keep_latest", f"SELECT {OFFSETS}, device_id, event_timestamp, temperature FROM latest")
def e1(spark, sf):
    return keep_latest(readings_of(spark, sf), READING_KEY, change_order()).select(
        "kafka_partition", "kafka_offset", "device_id", "event_timestamp", "temperature"
    )


@query("e2_quarantine_dedup", f"SELECT {OFFSETS}, rejection_reason FROM quarantine")
def e2(spark, sf):
    invalid = split_valid(classify(readings_of(spark, sf), CFG, AS_OF))[1]
    return invalid.select(
        "kafka_partition", "kafka_offset", F.col("dq_status").alias("rejection_reason")
    )


@query(
    "e3_utc_time",
    f"SELECT {OFFSETS}, event_timestamp FROM telemetry",
)
def e3(spark, sf):
    """The same instants written with a +05:30 offset come back as UTC."""
    shifted = F.date_format(
        F.col("event_timestamp") + F.expr("INTERVAL '05:30' HOUR TO MINUTE"),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'",
    )
    return telemetry(spark, sf).select(
        "kafka_partition", "kafka_offset", parse_utc(shifted).alias("event_timestamp")
    )


@query("e4_event_date", "SELECT event_date, COUNT(*) AS readings FROM silver GROUP BY event_date")
def e4(spark, sf):
    return (
        silver(readings_of(spark, sf), CFG, AS_OF)
        .groupBy("event_date")
        .agg(F.count("*").alias("readings"))
    )


@query(
    "e5_incremental_filter",
    f"""SELECT {OFFSETS}, ingested_at FROM bronze WHERE ingested_at > (SELECT COALESCE(MAX(ingested_at),
  TIMESTAMP '1900-01-01 00:00:00') FROM silver WHERE ingested_at <= TIMESTAMP '{LOADED_UNTIL}')""",
)
def e5(spark, sf):
    loaded = silver_of(spark, sf).where(F.col("ingested_at") <= instant(LOADED_UNTIL))
    return incremental(readings_of(spark, sf), loaded, "ingested_at").select(
        "kafka_partition", "kafka_offset", "ingested_at"
    )


@query("e6_upsert", f"SELECT {SILVER_LIST} FROM silver")
def e6(spark, sf):
    """Batches in two overlapping parts, the second applied twice."""
    columns = silver(readings_of(spark, sf), CFG, AS_OF)
    path = scratch_path(spark, "silver")
    order = ["kafka_offset", "kafka_partition"]
    early = columns.where("event_date <= DATE'2024-01-20'")
    late = columns.where("event_date >= DATE'2024-01-10'")
    for part in (early, late, late):
        upsert(part, path, READING_KEY, "event_date", order, ["region"])
    return spark.read.schema(SILVER).parquet(path)


@query(
    "e6_merge_newer_wins",
    """SELECT device_id, event_timestamp, kafka_offset, temperature FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id, event_timestamp ORDER BY kafka_offset DESC) AS pick
  FROM bronze) AS ordered WHERE pick = 1""",
)
def e6_merge(spark, sf):
    """Corrections already stored are not overwritten by the originals that arrive later."""
    columns = ["device_id", "event_timestamp", "kafka_offset", "temperature"]
    readings = readings_of(spark, sf).select(*columns)
    stored = keep_latest(
        readings.where("kafka_offset % 2 = 1"), READING_KEY, [F.desc("kafka_offset")]
    )
    late = newest_per_key(
        readings.where("kafka_offset % 2 = 0"), READING_KEY, ["kafka_offset"]
    )
    return merge(stored, late, READING_KEY, ["kafka_offset"])


@query(
    "e7_replay_guard",
    f"""SELECT {POSITION}, device_id FROM telemetry WHERE ingested_at > TIMESTAMP '{LOADED_UNTIL}'""",
)
def e7(spark, sf):
    """All records delivered again, twice; those in the log and the doubles are skipped."""
    records = telemetry(spark, sf)
    log = processing_log(records.where(F.col("ingested_at") <= instant(LOADED_UNTIL)), AS_OF)
    replayed = records.unionByName(records)
    return skip_processed(replayed, log).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "device_id"
    )


@query(
    "e7_unseen_offsets",
    f"""SELECT {POSITION}, device_id FROM telemetry WHERE ingested_at > TIMESTAMP '{LOADED_UNTIL}'""",
)
def e7_unseen(spark, sf):
    """As ``e7_replay_guard``, with ranges of offsets for a log."""
    records = telemetry(spark, sf)
    log = offset_ranges(records.where(F.col("ingested_at") <= instant(LOADED_UNTIL)))
    return unseen(records.unionByName(records), log).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "device_id"
    )


@query(
    "e7_offset_ranges",
    """SELECT 'silver' AS kafka_topic, kafka_partition, MIN(kafka_offset) AS first_offset, MAX(kafka_offset) AS last_offset
FROM (SELECT kafka_partition, kafka_offset, kafka_offset - ROW_NUMBER() OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS island
  FROM silver) AS placed
GROUP BY kafka_partition, island""",
)
def e7_ranges(spark, sf):
    """Offsets of the valid readings, loaded in two batches; rejected and older ones leave gaps."""
    records = silver_of(spark, sf).select(F.lit("silver").alias("kafka_topic"), "kafka_partition", "kafka_offset", "ingested_at")
    loaded = F.coalesce(F.col("ingested_at") <= instant(LOADED_UNTIL), F.lit(False))
    log = offset_ranges(records.where(loaded))
    return whole_ranges(offset_ranges(records.where(~loaded), log))


@query(
    "e8_insert_absent",
    "SELECT device_id, region, model, firmware_version FROM registered WHERE device_id NOT IN "
    "(SELECT DISTINCT device_id FROM telemetry WHERE device_id IS NOT NULL)",
)
def e8(spark, sf):
    known = telemetry(spark, sf).where("device_id IS NOT NULL").select("device_id")
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    columns = seeds.select("device_id", "region", "model", "firmware_version")
    return insert_absent(columns, known, ["device_id"])


# ------------------------------------------------------------- F. Joins


@query(
    "f1_events_with_stats",
    """SELECT device_id, event_timestamp, ROUND(rolling_7d_avg_temp, 6) AS rolling_avg,
  ROUND(rolling_7d_stddev_temp, 6) AS rolling_stddev FROM joined""",
)
def f1(spark, sf):
    return events_with_stats(silver_of(spark, sf), summary_of(spark, sf), CFG).select(
        "device_id",
        "event_timestamp",
        F.round("rolling_7d_avg_temp", 6).alias("rolling_avg"),
        F.round("rolling_7d_stddev_temp", 6).alias("rolling_stddev"),
    )


@query(
    "f2_latest_per_device",
    """SELECT device_id, MAX(event_timestamp) AS event_timestamp, ARG_MAX(temperature, event_timestamp) AS temperature,
  ARG_MAX(battery, event_timestamp) AS battery FROM silver GROUP BY device_id""",
)
def f2(spark, sf):
    return serving.latest_readings(
        silver_of(spark, sf), ["event_timestamp", "temperature", "battery"]
    )


@query(
    "f3_newest_day",
    "SELECT device_id, region, total_events FROM summary WHERE event_date = (SELECT MAX(event_date) FROM summary)",
)
def f3(spark, sf):
    summary = summary_of(spark, sf)
    newest = summary.agg(F.max("event_date")).scalar()
    return summary.where(F.col("event_date") == newest).select("device_id", "region", "total_events")


@query(
    "f4_unregistered_events",
    """SELECT device_id, COUNT(*) AS events FROM silver WHERE device_id NOT IN
  (SELECT device_id FROM registered WHERE region <> 'chicago') GROUP BY device_id""",
)
def f4(spark, sf):
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    parents = seeds.where("region <> 'chicago'")
    orphans = checks.check_foreign_key(silver_of(spark, sf), parents, "device_id")
    return orphans.groupBy("device_id").agg(F.count("*").alias("events"))


# ------------------------------------------- G. Gold: device-day summary

SUMMARY_GROUPS = {
    "g1_total_events": ["total_events"],
    "g2_active_hours": ["active_hours"],
    "g3_uptime": ["uptime_pct"],
    "g4_temperature": ["avg_temperature", "min_temperature", "max_temperature"],
    "g5_temperature_deviation": ["stddev_temperature"],
    "g6_humidity": ["avg_humidity", "min_humidity", "max_humidity"],
    "g7_battery_start": ["battery_start_of_day"],
    "g8_battery_end": ["battery_end_of_day"],
    "g9_min_battery": ["min_battery"],
    "g10_signal_strength": ["avg_signal_strength"],
    "g11_signal_counts": [
        "signal_excellent_count",
        "signal_good_count",
        "signal_fair_count",
        "signal_poor_count",
    ],
    "g12_flags": ["had_high_temp_alert", "had_critical_battery", "had_offline_event"],
    "g13_worst_battery": ["worst_battery_health"],
    "g14_first_last_times": ["first_event_at", "last_event_at", "last_updated_at"],
    "g15_battery_drain": ["battery_drain_today"],
    "g16_health_score": ["device_health_score"],
}


def _summary_query(name: str, columns: list[str]) -> None:
    wanted = [*GRAIN, *columns]

    @query(name, f"SELECT {', '.join(wanted)} FROM summary")
    def body(spark, sf):
        return device_summary(silver_of(spark, sf)).select(*wanted)


for _name, _columns in SUMMARY_GROUPS.items():
    _summary_query(_name, _columns)


@query("g_device_summary", "SELECT * FROM summary")
def g_all(spark, sf):
    """The whole summary straight from the events table."""
    return device_summary(silver(readings_of(spark, sf), CFG, AS_OF))


@query(
    "g13_worst_battery_by_severity",
    """SELECT event_date, device_id, region, CASE MIN(CASE battery_health WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END)
  WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS worst_battery_health
FROM silver GROUP BY event_date, device_id, region""",
)
def g13_severity(spark, sf):
    worst = device_summary(silver_of(spark, sf), severity_order=True)
    return worst.select(*GRAIN, "worst_battery_health")


# ------------------------------------------- H. Gold: anomaly detection


@query(
    "h1_previous_reading",
    "SELECT device_id, event_timestamp, temperature, prev_temperature, prev_event_timestamp FROM lagged",
)
def h1(spark, sf):
    readings = silver_of(spark, sf).select("device_id", "event_timestamp", "temperature")
    return with_lag(readings)


def _rolling(spark, sf):
    return rolling_stats(device_days(summary_of(spark, sf)), CFG)


@query(
    "h2_rolling_mean",
    "SELECT device_id, event_date, ROUND(rolling_7d_avg_temp, 6) AS rolling_avg FROM device_stats",
)
def h2(spark, sf):
    return _rolling(spark, sf).select(
        "device_id", "event_date", F.round("rolling_7d_avg_temp", 6).alias("rolling_avg")
    )


@query(
    "h3_rolling_deviation",
    "SELECT device_id, event_date, ROUND(rolling_7d_stddev_temp, 6) AS rolling_stddev FROM device_stats",
)
def h3(spark, sf):
    return _rolling(spark, sf).select(
        "device_id", "event_date", F.round("rolling_7d_stddev_temp", 6).alias("rolling_stddev")
    )


@query("h4_minutes_between", "SELECT device_id, event_timestamp, minutes_since_last FROM joined")
def h4(spark, sf):
    lagged = with_lag(silver_of(spark, sf).select("device_id", "event_timestamp", "temperature"))
    return lagged.select(
        "device_id",
        "event_timestamp",
        minutes_crossed(F.col("prev_event_timestamp"), F.col("event_timestamp")).alias(
            "minutes_since_last"
        ),
    )


ANOMALY_TYPES = {
    "h5_temp_spike": "TEMP_SPIKE",
    "h6_battery_critical": "BATTERY_CRITICAL",
    "h7_battery_warning": "BATTERY_WARNING",
    "h8_device_offline": "DEVICE_OFFLINE",
    "h9_signal_lost": "SIGNAL_LOST",
    "h10_rapid_temp_change": "RAPID_TEMP_CHANGE",
}
ANOMALY_SQL = """SELECT device_id, region, event_date, event_timestamp, anomaly_type, severity,
  ROUND(metric_value, 6) AS metric_value, ROUND(threshold_value, 6) AS threshold_value FROM anomalies"""


def _anomaly_values(found: DataFrame) -> DataFrame:
    return found.select(
        "device_id",
        "region",
        "event_date",
        "event_timestamp",
        "anomaly_type",
        "severity",
        F.round("metric_value", 6).alias("metric_value"),
        F.round("threshold_value", 6).alias("threshold_value"),
    )


def _found(spark, sf):
    """Anomalies computed now, from the Silver and summary tables."""
    return find_anomalies(silver_of(spark, sf), summary_of(spark, sf), CFG, AS_OF)


def _anomaly_query(name: str, kind: str) -> None:
    @query(name, f"{ANOMALY_SQL} WHERE anomaly_type = '{kind}'")
    def body(spark, sf):
        return _anomaly_values(_found(spark, sf).where(F.col("anomaly_type") == kind))


for _name, _kind in ANOMALY_TYPES.items():
    _anomaly_query(_name, _kind)


@query("h11_all_anomalies", ANOMALY_SQL)
def h11(spark, sf):
    return _anomaly_values(_found(spark, sf))


@query(
    "h12_descriptions",
    "SELECT device_id, event_timestamp, anomaly_type, description FROM anomalies",
)
def h12(spark, sf):
    return _found(spark, sf).select("device_id", "event_timestamp", "anomaly_type", "description")


@query("h13_anomaly_keys", "SELECT anomaly_id, device_id, anomaly_type FROM anomalies")
def h13(spark, sf):
    return _found(spark, sf).select("anomaly_id", "device_id", "anomaly_type")


@query("h14_detected_at", "SELECT detected_at, COUNT(*) AS anomalies_found FROM anomalies GROUP BY detected_at")
def h14(spark, sf):
    return _found(spark, sf).groupBy("detected_at").agg(F.count("*").alias("anomalies_found"))


@query(
    "h15_newest_first",
    "SELECT event_timestamp, device_id, anomaly_type FROM anomalies ORDER BY event_timestamp DESC, device_id, anomaly_type",
)
def h15(spark, sf):
    return newest_first(anomalies_of(spark, sf)).select("event_timestamp", "device_id", "anomaly_type")


# ---------------------------------------------------- I. Serving queries

SERVED = f"TIMESTAMP '{SERVED_AT}'"


@query(
    "i1_filters",
    f"SELECT event_date, device_id, total_events FROM summary WHERE event_date >= CAST({SERVED} AS DATE) - 5 AND region = 'houston'",
)
def i1(spark, sf):
    recent = serving.last_days(summary_of(spark, sf), SERVED_AT, 5)
    return serving.in_region(recent, "houston").select("event_date", "device_id", "total_events")


@query(
    "i2_kpi_summary",
    f"""SELECT COUNT(DISTINCT device_id) AS total_devices, CAST(SUM(total_events) AS BIGINT) AS total_events,
  {mean('uptime_pct', 1)} AS avg_uptime, {mean('avg_temperature', 1)} AS avg_temperature,
  CAST(SUM(had_critical_battery) AS BIGINT) AS critical_battery_devices, CAST(SUM(had_offline_event) AS BIGINT) AS offline_events
FROM summary WHERE event_date >= CAST({SERVED} AS DATE) - 7""",
)
def i2(spark, sf):
    return serving.kpi_summary(summary_of(spark, sf), SERVED_AT)


@query(
    "i3_device_status",
    f"SELECT {', '.join(serving.STATUS_COLUMNS)} FROM summary WHERE event_date = (SELECT MAX(event_date) FROM summary)",
)
def i3(spark, sf):
    return serving.device_status(summary_of(spark, sf))


@query(
    "i4_temperature_trend",
    f"""SELECT date_trunc('hour', event_timestamp) AS hour, region, {mean('temperature', 2)} AS avg_temp,
  MAX(temperature) AS max_temp, MIN(temperature) AS min_temp
FROM silver WHERE event_timestamp >= {SERVED} - INTERVAL '7' DAY GROUP BY 1, 2 ORDER BY hour DESC, region LIMIT 500""",
)
def i4(spark, sf):
    return serving.temperature_trend(silver_of(spark, sf), SERVED_AT, limit=500)


RECENT_SQL = f"""FROM anomalies WHERE event_date >= CAST({SERVED} AS DATE) - 1
ORDER BY event_timestamp DESC, device_id, anomaly_type"""


@query(
    "i5_recent_anomalies",
    f"SELECT device_id, region, anomaly_type, severity, description, event_timestamp {RECENT_SQL} LIMIT 50",
)
def i5(spark, sf):
    return serving.recent_anomalies(anomalies_of(spark, sf), SERVED_AT, limit=50)


@query(
    "i6_quarantine_breakdown",
    f"""SELECT COUNT(*) AS total_quarantined, rejection_reason,
  CAST(COUNT(*) AS DOUBLE) * 100 / SUM(COUNT(*)) OVER () AS pct
FROM quarantine WHERE quarantined_at >= {SERVED} - INTERVAL '24' HOUR GROUP BY rejection_reason""",
)
def i6(spark, sf):
    return serving.quarantine_breakdown(quarantine_of(spark, sf), SERVED_AT)


@query(
    "i7_latest_positions",
    f"""SELECT device_id, newest.region, newest.latitude, newest.longitude, newest.temperature, newest.battery, newest.signal_strength, newest.is_online
FROM (SELECT device_id, ARG_MAX({{'region': region, 'latitude': latitude, 'longitude': longitude, 'temperature': temperature,
    'battery': battery, 'signal_strength': signal_strength, 'is_online': is_online}}, event_timestamp) AS newest
  FROM silver GROUP BY device_id HAVING MAX(event_timestamp) >= {SERVED} - INTERVAL '2' HOUR)
ORDER BY device_id LIMIT 200""",
)
def i7(spark, sf):
    return serving.latest_positions(silver_of(spark, sf), SERVED_AT, limit=200)


@query(
    "i8_health_leaderboard",
    """SELECT device_id, region, CASE WHEN device_health_score < 40 THEN 'Critical' WHEN device_health_score < 70 THEN 'Warning'
  ELSE 'Healthy' END AS health, device_health_score, avg_temperature, min_battery, avg_signal_strength, uptime_pct
FROM summary WHERE event_date = (SELECT MAX(event_date) FROM summary)
ORDER BY device_health_score, device_id, region LIMIT 15""",
)
def i8(spark, sf):
    return serving.health_leaderboard(summary_of(spark, sf), limit=15)


@query(
    "i9_online_state",
    "SELECT device_id, event_timestamp, CASE WHEN is_online THEN 'online' ELSE 'offline' END AS state FROM silver",
)
def i9(spark, sf):
    return silver_of(spark, sf).select(
        "device_id", "event_timestamp", serving.online_state().alias("state")
    )


@query(
    "i10_alert_feed",
    f"""SELECT device_id, anomaly_type, CASE WHEN severity = 'critical' THEN 'red' ELSE 'yellow' END AS marker, description,
  strftime(event_timestamp, '%Y-%m-%d %H:%M') AS seen_at, region FROM (SELECT * {RECENT_SQL} LIMIT 20) AS newest""",
)
def i10(spark, sf):
    return serving.alert_feed(anomalies_of(spark, sf), SERVED_AT, limit=20)


# ----------------------------------------------------- J. Measure export

TODAY = f"event_date = CAST({SERVED} AS DATE)"


@query(
    "j1_today_slice",
    f"SELECT device_id, region, avg_temperature, device_health_score, uptime_pct, active_hours, total_events FROM summary WHERE {TODAY}",
)
def j1(spark, sf):
    return measures.today_slice(summary_of(spark, sf), SERVED_AT).select(
        "device_id",
        "region",
        "avg_temperature",
        "device_health_score",
        "uptime_pct",
        "active_hours",
        "total_events",
    )


LONG_LIST = f"device_id, region, measure_name, measure_value, 'DOUBLE' AS value_type, (epoch_us({SERVED}) // 1000) AS time"


@query("j2_telemetry_measures", f"SELECT {LONG_LIST} FROM long_telemetry WHERE {TODAY}")
def j2(spark, sf):
    rows = measures.today_slice(summary_of(spark, sf), SERVED_AT)
    return measures.telemetry_measures(rows, SERVED_AT)


@query("j3_health_measures", f"SELECT {LONG_LIST} FROM long_health WHERE {TODAY}")
def j3(spark, sf):
    rows = measures.today_slice(summary_of(spark, sf), SERVED_AT)
    return measures.health_measures(rows, SERVED_AT)


LAST_HOUR = f"FROM anomalies WHERE event_timestamp >= {SERVED} - INTERVAL '1' HOUR GROUP BY anomaly_type, region"


@query("j4_anomaly_counts", f"SELECT anomaly_type, region, COUNT(*) AS anomaly_count {LAST_HOUR}")
def j4(spark, sf):
    return measures.anomaly_counts(anomalies_of(spark, sf), SERVED_AT)


@query(
    "j5_anomaly_measures",
    f"""SELECT anomaly_type, region, 'anomaly_count' AS measure_name, COUNT(*) AS measure_value, 'BIGINT' AS value_type,
  (epoch_us({SERVED}) // 1000) AS time {LAST_HOUR}""",
)
def j5(spark, sf):
    counts = measures.anomaly_counts(anomalies_of(spark, sf), SERVED_AT)
    return measures.anomaly_measures(counts, SERVED_AT)


@query(
    "j6_snapshot_time",
    f"SELECT (epoch_us({SERVED}) // 1000) AS time, COUNT(*) AS measures FROM long_telemetry WHERE {TODAY} GROUP BY 1",
)
def j6(spark, sf):
    rows = measures.today_slice(summary_of(spark, sf), SERVED_AT)
    stamped = measures.telemetry_measures(rows, SERVED_AT)
    return stamped.groupBy("time").agg(F.count("*").alias("measures"))


@query("j7_ensure_target", f"SELECT {LONG_LIST} FROM long_health WHERE {TODAY}")
def j7(spark, sf):
    """Creating the target again leaves the exported measures alone."""
    rows = measures.today_slice(summary_of(spark, sf), SERVED_AT)
    long = measures.health_measures(rows, SERVED_AT)
    path = scratch_path(spark, "measures")
    ensure_table(long, path)
    write_measures(long, path)
    ensure_table(long, path)
    return spark.read.schema(long.schema).parquet(path)


# ------------------------------------------------ K. Time-series panels


def _health_history(spark, sf):
    """Health measures of every device-day, stamped with their last update."""
    return measures.health_measures(summary_of(spark, sf), F.col("last_updated_at"))


def _telemetry_history(spark, sf):
    return measures.telemetry_measures(summary_of(spark, sf), F.col("last_updated_at"))


def _count_history(spark, sf):
    """Anomaly counts of every hour, stamped with the end of the hour."""
    hour = truncate("hour", F.col("event_timestamp")).alias("hour")
    counts = (
        anomalies_of(spark, sf)
        .groupBy("anomaly_type", "region", hour)
        .agg(F.count("*").alias("anomaly_count"))
    )
    return measures.anomaly_measures(counts, F.col("hour") + F.expr("INTERVAL '1' HOUR"))


def since(hours: int, time: str = "time") -> str:
    return f"{time} > (epoch_us({SERVED} - INTERVAL '{hours}' HOUR) // 1000)"


HISTORY = "(epoch_us(last_updated_at) // 1000)"


@query(
    "k1_total_events",
    f"SELECT SUM(measure_value) AS total FROM long_health WHERE measure_name = 'total_events' AND {since(6, HISTORY)}",
)
def k1(spark, sf):
    return panels.panel_total_events(_health_history(spark, sf), SERVED_AT)


@query(
    "k1_total_events_latest",
    f"""SELECT SUM(measure_value) AS total FROM (SELECT device_id, region, CAST(last_updated_at AS DATE) AS day,
  ARG_MAX(measure_value, last_updated_at) AS measure_value FROM long_health
  WHERE measure_name = 'total_events' AND {since(72, HISTORY)} GROUP BY 1, 2, 3) AS snapshots""",
)
def k1_latest(spark, sf):
    return panels.panel_total_events_latest(_health_history(spark, sf), SERVED_AT, 72)


def _panel_mean_sql(measure: str) -> str:
    return (
        f"SELECT {plain_mean('measure_value')} AS mean FROM long_health "
        f"WHERE measure_name = '{measure}' AND {since(6, HISTORY)}"
    )


@query("k2_mean_uptime", _panel_mean_sql("uptime_pct"))
def k2(spark, sf):
    return panels.panel_mean(_health_history(spark, sf), "uptime_pct", SERVED_AT)


@query("k3_mean_health", _panel_mean_sql("health_score"))
def k3(spark, sf):
    return panels.panel_mean(_health_history(spark, sf), "health_score", SERVED_AT)


@query(
    "k4_anomaly_total",
    f"SELECT CAST(SUM(measure_value) AS BIGINT) AS total FROM hourly_counts WHERE {since(24)}",
)
def k4(spark, sf):
    return panels.panel_anomaly_total(_count_history(spark, sf), SERVED_AT)


@query(
    "k4_critical_total",
    f"SELECT COUNT(*) AS total FROM anomalies WHERE event_timestamp > {SERVED} - INTERVAL '24' HOUR AND severity = 'critical'",
)
def k4_critical(spark, sf):
    return panels.panel_critical_total(anomalies_of(spark, sf), SERVED_AT)


@query(
    "k5_temperature_bins",
    f"""SELECT time_bucket(INTERVAL '5' MINUTE, last_updated_at) AS time_bin, device_id, {plain_mean('measure_value')} AS avg_temp
FROM long_telemetry WHERE measure_name = 'avg_temperature' AND {since(240, HISTORY)} GROUP BY 1, 2""",
)
def k5(spark, sf):
    return panels.panel_temperature(_telemetry_history(spark, sf), SERVED_AT, 240)


@query(
    "k6_anomalies_by_region",
    f"""SELECT region, anomaly_type, CAST(SUM(measure_value) AS BIGINT) AS total FROM hourly_counts
WHERE {since(6)} GROUP BY region, anomaly_type""",
)
def k6(spark, sf):
    return panels.panel_anomalies_by_region(_count_history(spark, sf), SERVED_AT)


@query(
    "k7_threshold_bands",
    """SELECT event_date, device_id, region,
  CASE WHEN uptime_pct >= 98 THEN 'green' WHEN uptime_pct >= 90 THEN 'yellow' ELSE 'red' END AS uptime_band,
  CASE WHEN device_health_score >= 90 THEN 'green' WHEN device_health_score >= 75 THEN 'yellow'
       WHEN device_health_score >= 50 THEN 'orange' ELSE 'red' END AS health_band,
  CASE WHEN total_events >= 10 THEN 'red' WHEN total_events >= 1 THEN 'yellow' ELSE 'green' END AS count_band FROM summary""",
)
def k7(spark, sf):
    return summary_of(spark, sf).select(
        *GRAIN,
        panels.band("uptime_pct", "uptime").alias("uptime_band"),
        panels.band("device_health_score", "health").alias("health_band"),
        panels.band("total_events", "anomalies").alias("count_band"),
    )


@query(
    "k8_last_value",
    """SELECT device_id, measure_name, ARG_MAX(measure_value, last_updated_at) AS last_value,
  (epoch_us(MAX(last_updated_at)) // 1000) AS last_time FROM long_telemetry GROUP BY device_id, measure_name""",
)
def k8(spark, sf):
    return panels.last_value(_telemetry_history(spark, sf), ["device_id", "measure_name"])


# ------------------------------------------------------------ L. Alerting


@query("l1_alert_filter", f"SELECT {SILVER_LIST} FROM silver WHERE temperature > 50 OR battery < 10")
def l1(spark, sf):
    return alerts.alert_filter(silver_of(spark, sf), CFG)


ALERT_TYPE_SQL = """CASE anomaly_type WHEN 'TEMP_SPIKE' THEN 'high_temp' WHEN 'DEVICE_OFFLINE' THEN 'offline' ELSE 'low_battery' END"""


@query(
    "l2_device_alerts",
    f"""SELECT anomaly_id AS id, device_id, {ALERT_TYPE_SQL} AS alert_type, severity, description AS message,
  event_timestamp AS triggered_at, CAST(NULL AS TIMESTAMP) AS resolved_at, FALSE AS is_resolved FROM anomalies
WHERE anomaly_type IN ('TEMP_SPIKE', 'BATTERY_CRITICAL', 'BATTERY_WARNING', 'DEVICE_OFFLINE')""",
)
def l2(spark, sf):
    return alerts.device_alerts(anomalies_of(spark, sf))


def _episodes(spark, sf):
    """Alert episodes, with the busy device-days taken from the summary."""
    hot = hot_days(summary_of(spark, sf), ["device_id"], "event_date", "total_events", CFG)
    return alerts.alert_episodes(silver_of(spark, sf), CFG, hot)


EPISODES = """(SELECT device_id, alert_type, severity, event_timestamp AS triggered_at, resolved_at FROM (
  SELECT *, LEAD(event_timestamp) OVER (PARTITION BY device_id, alert_type ORDER BY event_timestamp) AS resolved_at FROM (
    SELECT *, LAG(active) OVER (PARTITION BY device_id, alert_type ORDER BY event_timestamp) AS was_active FROM (
      SELECT device_id, event_timestamp, 'high_temp' AS alert_type, 'critical' AS severity, temperature > 50 AS active FROM silver
      UNION ALL SELECT device_id, event_timestamp, 'low_battery', 'critical', battery < 10 FROM silver
      UNION ALL SELECT device_id, event_timestamp, 'offline', 'warning', NOT is_online FROM silver) AS flags) AS steps
  WHERE active <> COALESCE(was_active, FALSE)) AS changes WHERE active)"""


@query(
    "l3_alert_lifecycle",
    f"SELECT device_id, alert_type, severity, triggered_at, resolved_at, resolved_at IS NOT NULL AS is_resolved FROM {EPISODES} AS e",
)
def l3(spark, sf):
    return _episodes(spark, sf).select(
        "device_id", "alert_type", "severity", "triggered_at", "resolved_at", "is_resolved"
    )


@query(
    "l3_unresolved",
    f"SELECT device_id, alert_type, triggered_at FROM {EPISODES} AS e WHERE resolved_at IS NULL",
)
def l3_unresolved(spark, sf):
    open_alerts = alerts.unresolved(_episodes(spark, sf))
    return open_alerts.select("device_id", "alert_type", "triggered_at")


@query(
    "l3_newest_per_device",
    f"""SELECT device_id, alert_type, triggered_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id
  ORDER BY triggered_at DESC, alert_type) AS pick FROM {EPISODES} AS e) AS ordered WHERE pick = 1""",
)
def l3_newest(spark, sf):
    newest = alerts.newest_alert(_episodes(spark, sf))
    return newest.select("device_id", "alert_type", "triggered_at")


@query(
    "l3_resolve",
    f"""SELECT {key('device_id', stamp('triggered_at'), 'alert_type')} AS id, device_id,
  COALESCE(resolved_at, TIMESTAMP '{AS_OF}') AS resolved_at, TRUE AS is_resolved FROM {EPISODES} AS e""",
)
def l3_resolve(spark, sf):
    """Every alert still open is resolved at the pinned time."""
    found = _episodes(spark, sf)
    resolutions = alerts.unresolved(found).select("id", instant(AS_OF).alias("resolved_at"))
    resolved = alerts.resolve_alerts(found, resolutions)
    return resolved.select("id", "device_id", "resolved_at", "is_resolved")


@query(
    "l4_quarantine_spike",
    f"""SELECT rejection_reason, COUNT(*) AS row_count FROM quarantine
WHERE quarantined_at >= {SERVED} - INTERVAL '48' HOUR GROUP BY rejection_reason HAVING COUNT(*) > 3""",
)
def l4(spark, sf):
    return alerts.quarantine_spike(quarantine_of(spark, sf), SERVED_AT, 3, 48)


def _alarm_sql(missing: str) -> str:
    return f"""SELECT region, period_start, average,
  CASE WHEN COUNT(breach) OVER w < 2 THEN 'INSUFFICIENT_DATA' WHEN MIN(breach) OVER w = 1 THEN 'ALARM' ELSE 'OK' END AS state
FROM (SELECT g.region, g.period_start, a.average,
    CASE WHEN a.average IS NULL THEN {missing} WHEN a.average >= 25 THEN 1 ELSE 0 END AS breach
  FROM (SELECT region, UNNEST(generate_series(MIN(p), MAX(p), INTERVAL '5' MINUTE)) AS period_start
        FROM (SELECT region, time_bucket(INTERVAL '5' MINUTE, event_timestamp) AS p FROM silver) AS bins GROUP BY region) AS g
  LEFT JOIN (SELECT region, time_bucket(INTERVAL '5' MINUTE, event_timestamp) AS period_start, {plain_mean('temperature')} AS average
        FROM silver GROUP BY 1, 2) AS a ON g.region = a.region AND g.period_start = a.period_start) AS states
WINDOW w AS (PARTITION BY region ORDER BY period_start ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"""


@query("l5_metric_alarm", _alarm_sql("NULL"))
def l5(spark, sf):
    return alerts.metric_alarm(
        silver_of(spark, sf), ["region"], "event_timestamp", "temperature", ">=", 25.0, 2
    )


@query("l5_metric_alarm_breaching", _alarm_sql("1"))
def l5_breaching(spark, sf):
    return alerts.metric_alarm(
        silver_of(spark, sf),
        ["region"],
        "event_timestamp",
        "temperature",
        ">=",
        25.0,
        2,
        missing="breaching",
    )


def _notices_sql(group: str, member: str) -> str:
    """Notices from the rules, one after another: each round opens every group's next one."""
    return f"""SELECT {group}, opened_at, notified_at, reason, array_to_string(known, ',') AS known, alert_count FROM (
WITH RECURSIVE seconds AS (
  SELECT {group}, hash({group}) AS g, date_trunc('second', event_timestamp) AS moment, {member} AS member, COUNT(*) AS n
  FROM anomalies GROUP BY ALL),
sent AS (
  SELECT f.g, f.opened_at, f.opened_at + INTERVAL 30 SECOND AS notified_at, 'new' AS reason, LIST(DISTINCT s.member) AS known
  FROM (SELECT g, MIN(moment) AS opened_at FROM seconds GROUP BY g) AS f
  JOIN seconds AS s ON s.g = f.g AND s.moment <= f.opened_at + INTERVAL 30 SECOND GROUP BY ALL
  UNION ALL
  SELECT o.g, o.opened_at, o.notified_at, o.reason,
    list_distinct(list_concat(CASE WHEN o.reason = 'new' THEN [] ELSE ANY_VALUE(o.known) END, LIST(DISTINCT s.member))) AS known
  FROM (SELECT g, opened_at, known, CASE WHEN opened_at >= latest + INTERVAL 4 HOUR THEN 'new' ELSE 'change' END AS reason,
      CASE WHEN opened_at >= latest + INTERVAL 4 HOUR THEN opened_at + INTERVAL 30 SECOND
        ELSE GREATEST(opened_at, latest + INTERVAL 5 MINUTE) END AS notified_at
    FROM (SELECT p.g, p.notified_at AS latest, ANY_VALUE(p.known) AS known, MIN(s.moment) AS opened_at FROM sent AS p JOIN seconds AS s
      ON s.g = p.g AND s.moment > p.notified_at
        AND (s.moment >= p.notified_at + INTERVAL 4 HOUR OR NOT list_contains(p.known, s.member))
      GROUP BY p.g, p.notified_at) AS n) AS o
  JOIN seconds AS s ON s.g = o.g AND s.moment BETWEEN o.opened_at AND o.notified_at
  GROUP BY o.g, o.opened_at, o.notified_at, o.reason),
spans AS (SELECT *, LEAD(opened_at) OVER (PARTITION BY g ORDER BY opened_at) AS until FROM sent)
SELECT {', '.join(f's.{c.strip()}' for c in group.split(','))}, p.opened_at, p.notified_at, p.reason, list_sort(p.known) AS known, SUM(s.n)::BIGINT AS alert_count
FROM spans AS p JOIN seconds AS s ON s.g = p.g AND s.moment >= p.opened_at AND (p.until IS NULL OR s.moment < p.until) GROUP BY ALL) AS followed"""


def _notice_values(found: DataFrame) -> DataFrame:
    return found.withColumn("known", F.array_join("known", ","))


@query("l6_repeat_notices", _notices_sql("region", "anomaly_type"))
def l6_repeat(spark, sf):
    """Groups by region; another type of anomaly is a change."""
    return _notice_values(repeat_suppressed(anomalies_of(spark, sf), Route(("region",), "anomaly_type")))


@query(
    "l6_throttled_notices",
    """SELECT anomaly_type, region, time_bucket(INTERVAL '4' HOUR, event_timestamp) AS interval_start,
  MIN(event_timestamp) AS notified_at, COUNT(*) AS alert_count FROM anomalies GROUP BY 1, 2, 3""",
)
def l6(spark, sf):
    return alerts.throttle(anomalies_of(spark, sf), ["anomaly_type", "region"])


@query("l7_low_battery", "SELECT device_id, event_timestamp, battery FROM silver WHERE battery < 20")
def l7_battery(spark, sf):
    return alerts.low_battery(silver_of(spark, sf), CFG).select(
        "device_id", "event_timestamp", "battery"
    )


@query("l7_offline", "SELECT device_id, event_timestamp FROM silver WHERE is_online = FALSE")
def l7_offline(spark, sf):
    return alerts.offline(silver_of(spark, sf)).select("device_id", "event_timestamp")


@query(
    "l7_active_devices",
    "SELECT device_id, region, model FROM registered WHERE region = 'miami'",
)
def l7_active(spark, sf):
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    return alerts.active_devices(seeds, "miami").select("device_id", "region", "model")


# ------------------------------------------------------------ M. Registry


@query(
    "m1_registry_rows",
    f"""SELECT device_id, region, model, firmware_version, TIMESTAMP '{AS_OF}' AS registered_at,
  CAST(NULL AS TIMESTAMP) AS last_seen_at, TRUE AS is_active FROM registered""",
)
def m1(spark, sf):
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    return seeds.drop("metadata")


@query(
    "m2_refresh_registry",
    """SELECT r.device_id, COALESCE(o.region, r.region) AS region, COALESCE(o.model, r.model) AS model,
  COALESCE(o.firmware_version, r.firmware_version) AS firmware_version, o.last_seen_at
FROM registered AS r LEFT JOIN (
  SELECT device_id, region, model, firmware_version, event_timestamp AS last_seen_at FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY event_timestamp DESC, kafka_offset DESC) AS pick
    FROM telemetry WHERE device_id IS NOT NULL AND event_timestamp IS NOT NULL) AS ordered WHERE pick = 1) AS o
  ON r.device_id = o.device_id""",
)
def m2(spark, sf):
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    fresh = registry.refresh_registry(seeds, telemetry(spark, sf))
    return fresh.select("device_id", "region", "model", "firmware_version", "last_seen_at")


# -------------------------------------------------------------- N. Checks


@query(
    "n1_not_null",
    f"SELECT {OFFSETS} FROM bronze WHERE {' OR '.join(f'{c} IS NULL' for c in checks.BRONZE_NOT_NULL)}",
)
def n1(spark, sf):
    broken = checks.check_not_null(readings_of(spark, sf), checks.BRONZE_NOT_NULL)
    return broken.select("kafka_partition", "kafka_offset")


@query("n2_length", f"SELECT {OFFSETS}, region FROM bronze WHERE length(region) NOT BETWEEN 3 AND 7")
def n2(spark, sf):
    return checks.check_length(readings_of(spark, sf), "region", 3, 7).select(
        "kafka_partition", "kafka_offset", "region"
    )


@query(
    "n3_value_ranges",
    f"""SELECT {OFFSETS} FROM bronze WHERE latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180
  OR temperature NOT BETWEEN -50 AND 80 OR humidity NOT BETWEEN 0 AND 100 OR battery NOT BETWEEN 0 AND 100""",
)
def n3(spark, sf):
    broken = checks.check_between(readings_of(spark, sf), checks.value_ranges(CFG))
    return broken.select("kafka_partition", "kafka_offset")


@query(
    "n4_accepted_values",
    f"SELECT {OFFSETS}, cdc_operation FROM telemetry WHERE cdc_operation NOT IN ('r', 'c', 'u')",
)
def n4(spark, sf):
    broken = checks.check_accepted(telemetry(spark, sf), "cdc_operation", ["r", "c", "u"])
    return broken.select("kafka_partition", "kafka_offset", "cdc_operation")


@query(
    "n5_coordinates",
    f"SELECT {OFFSETS}, latitude, longitude FROM latest WHERE latitude < -90 OR latitude > 90 OR longitude < -180 OR longitude > 180",
)
def n5(spark, sf):
    """Run on the readings before the quality split, where it finds something."""
    newest = keep_latest(readings_of(spark, sf), READING_KEY, change_order())
    return checks.check_coordinates(newest).select(
        "kafka_partition", "kafka_offset", "latitude", "longitude"
    )


@query(
    "n6_silver_not_null",
    f"SELECT {OFFSETS}, device_id FROM silver WHERE {' OR '.join(f'{c} IS NULL' for c in checks.SILVER_NOT_NULL)}",
)
def n6(spark, sf):
    broken = checks.check_not_null(silver_of(spark, sf), checks.SILVER_NOT_NULL)
    return broken.select("kafka_partition", "kafka_offset", "device_id")


@query(
    "n7_timestamps",
    f"""SELECT {OFFSETS}, event_timestamp FROM latest WHERE event_timestamp > TIMESTAMP '{AS_OF}'
  OR event_timestamp < TIMESTAMP '2020-01-01 00:00:00'""",
)
def n7(spark, sf):
    newest = keep_latest(readings_of(spark, sf), READING_KEY, change_order())
    return checks.check_times(newest, AS_OF).select(
        "kafka_partition", "kafka_offset", "event_timestamp"
    )


@query(
    "n8_unique_key",
    "SELECT device_id, event_timestamp, COUNT(*) AS row_count FROM bronze GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def n8(spark, sf):
    return checks.check_unique(readings_of(spark, sf), READING_KEY)


@query(
    "n9_foreign_key",
    f"SELECT {OFFSETS}, device_id FROM silver WHERE device_id NOT IN (SELECT device_id FROM registered WHERE region <> 'miami')",
)
def n9(spark, sf):
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    orphans = checks.check_foreign_key(
        silver_of(spark, sf), seeds.where("region <> 'miami'"), "device_id"
    )
    return orphans.select("kafka_partition", "kafka_offset", "device_id")


@query("n10_row_count", "SELECT COUNT(*) AS row_count FROM registered")
def n10(spark, sf):
    seeds = registry.registry_rows(read_snapshot(spark, sf, "customer"), "c_custkey", AS_OF)
    return checks.row_count(seeds)


@query(
    "n11_run_counters",
    f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE error IS NULL) AS sent, COUNT(*) FILTER (WHERE error IS NOT NULL) AS invalid
FROM (SELECT {INGRESS_SQL} AS error FROM (SELECT *, {MISSING_SQL} AS missing FROM telemetry) AS listed) AS judged""",
)
def n11(spark, sf):
    """Counters observed while the checked events are written."""
    checked = telemetry(spark, sf).withColumn("timestamp", F.col("event_timestamp"))
    observed, counters = checks.run_counters(checked.withColumn("error", ingress_error(CFG)))
    observed.drop("timestamp").write.parquet(scratch_path(spark, "checked"))
    seen = counters.get
    return spark.range(1).select(
        *(F.lit(seen[c]).cast("bigint").alias(c) for c in ("total", "sent", "invalid"))
    )


# ------------------------------------------------------ O. Streaming jobs


def _raw_files(spark, sf) -> str:
    path = scratch_path(spark, "raw")
    _raw(spark, sf).repartition(stream_files(spark)).write.parquet(path)
    return path


def _silver_stream(spark, sf):
    """Silver readings as a stream, file after file of event time."""
    path = scratch_path(spark, "readings")
    silver_of(spark, sf).repartitionByRange(stream_files(spark), "event_timestamp").write.parquet(path)
    return spark.readStream.schema(SILVER).option("maxFilesPerTrigger", half(spark)).parquet(path)


def _run_append(spark, stream: DataFrame, label: str) -> DataFrame:
    target = scratch_path(spark, label)
    drained(jobs.start_append(stream, target, scratch_path(spark, "checkpoint")))
    return spark.read.schema(stream.schema).parquet(target)


def _run_updates(spark, stream: DataFrame, keys: list[str], time: str, label: str) -> DataFrame:
    """Running aggregates upserted by key: the last update of each window remains."""
    target = scratch_path(spark, label)
    dated = stream.withColumn("event_date", F.to_date(time))
    drained(
        jobs.start_upserts(
            dated, target, keys, "event_date", scratch_path(spark, "checkpoint"), mode="update"
        )
    )
    return spark.read.schema(dated.schema).parquet(target).drop("event_date")


def _run_gold(
    spark, sf, aggregate: Callable[[DataFrame], DataFrame], label: str, sort_by: list[str] | None = None
) -> DataFrame:
    """A Gold table kept up by batches of raw files in any order."""
    lake, target = Lake(scratch_path(spark, "lake")), scratch_path(spark, label)
    drained(
        jobs.start_silver(
            spark,
            _raw_files(spark, sf),
            lake,
            scratch_path(spark, "checkpoint"),
            cfg=CFG,
            as_of=AS_OF,
            max_files=half(spark),
            then=[jobs.gold_step(lake, target, aggregate, sort_by)],
        )
    )
    schema = aggregate(lake.read_silver(spark)).schema
    return spark.read.schema(schema).parquet(target)


@query("o1_bronze_stream", f"SELECT {OFFSETS}, {DEVICE_LIST}, event_timestamp FROM bronze")
def o1(spark, sf):
    target = scratch_path(spark, "bronze")
    drained(
        jobs.start_bronze(
            spark, _raw_files(spark, sf), target, scratch_path(spark, "checkpoint"), max_files=half(spark)
        )
    )
    return spark.read.parquet(target).select(
        "kafka_partition",
        "kafka_offset",
        *(c.strip() for c in DEVICE_LIST.split(",")),
        "event_timestamp",
    )


@query("o2_silver_stream", f"SELECT {SILVER_LIST} FROM silver")
def o2(spark, sf):
    lake = Lake(scratch_path(spark, "lake"))
    drained(
        jobs.start_silver(
            spark,
            _raw_files(spark, sf),
            lake,
            scratch_path(spark, "checkpoint"),
            cfg=CFG,
            as_of=AS_OF,
            max_files=half(spark),
        )
    )
    return lake.read_silver(spark)


@query(
    "o3_five_minute_stream",
    f"""SELECT time_bucket(INTERVAL '5' MINUTE, event_timestamp) AS time_bin, device_id, {plain_mean('temperature')} AS avg_temp
FROM silver GROUP BY 1, 2""",
)
def o3(spark, sf):
    def windows(silver: DataFrame) -> DataFrame:
        return aggregates.five_minute_temperature(silver).withColumn("event_date", F.to_date("time_bin"))

    return _run_gold(spark, sf, windows, "five-minute").drop("event_date")


@query(
    "o4_hourly_stream",
    f"""SELECT date_trunc('hour', event_timestamp) AS hour, region, {mean('temperature', 2)} AS avg_temp,
  MAX(temperature) AS max_temp, MIN(temperature) AS min_temp FROM silver GROUP BY 1, 2""",
)
def o4(spark, sf):
    def trend(silver: DataFrame) -> DataFrame:
        return aggregates.hourly_trend(silver).withColumn("event_date", F.to_date("hour"))

    return _run_gold(spark, sf, trend, "hourly").drop("event_date")


@query("o5_summary_stream", "SELECT * FROM summary")
def o5(spark, sf):
    summary = _run_gold(spark, sf, lambda silver: device_summary(silver, cfg=CFG), "summary", ["region"])
    return summary.select(*SUMMARY.fieldNames())


@query("o6_rapid_change_stream", f"{ANOMALY_SQL} WHERE anomaly_type = 'RAPID_TEMP_CHANGE'")
def o6(spark, sf):
    lake, target = Lake(scratch_path(spark, "lake")), scratch_path(spark, "rapid")
    drained(
        jobs.start_silver(
            spark,
            _raw_files(spark, sf),
            lake,
            scratch_path(spark, "checkpoint"),
            cfg=CFG,
            as_of=AS_OF,
            max_files=half(spark),
            then=[jobs.rapid_change_step(lake, target, CFG, AS_OF)],
        )
    )
    return _anomaly_values(jobs.read_raised(spark, target))


@query(
    "o7_alert_stream",
    f"{ANOMALY_SQL} WHERE anomaly_type IN ('BATTERY_CRITICAL', 'BATTERY_WARNING', 'DEVICE_OFFLINE', 'SIGNAL_LOST')",
)
def o7(spark, sf):
    target = scratch_path(spark, "alerts")
    drained(
        jobs.start_alerts(
            _silver_stream(spark, sf), target, scratch_path(spark, "checkpoint"), cfg=CFG, as_of=AS_OF
        )
    )
    return _anomaly_values(spark.read.schema(ANOMALIES).parquet(target))


def _refreshed_lake(spark, sf) -> Lake:
    """Two loads that meet on every device-day; the second has late and corrected readings."""
    lake, readings = Lake(scratch_path(spark, "lake")), readings_of(spark, sf)
    odd = F.pmod("kafka_offset", F.lit(2)) == 1
    for part in (~odd, odd):
        load_silver(readings.where(part), lake, CFG, AS_OF, [refresh_step(lake, CFG, AS_OF)])
    return lake


@query("b8_incremental_summary", "SELECT * FROM summary")
def b8_incremental_summary(spark, sf):
    return _refreshed_lake(spark, sf).read_summary(spark)


@query("b8_incremental_anomalies", ANOMALY_SQL)
def b8_incremental_anomalies(spark, sf):
    return _anomaly_values(_refreshed_lake(spark, sf).read_anomalies(spark))


@query("o8_spike_stream", f"{ANOMALY_SQL} WHERE anomaly_type = 'TEMP_SPIKE'")
def o8(spark, sf):
    target = scratch_path(spark, "spikes")
    step = jobs.spike_step(lake_for(spark, sf), target, CFG, AS_OF)
    drained(
        jobs.start_batches(_silver_stream(spark, sf), step, scratch_path(spark, "checkpoint"))
    )
    return _anomaly_values(spark.read.schema(ANOMALIES).parquet(target))


@query(
    "o9_replay_dedup_stream",
    'SELECT kafka_topic AS topic, kafka_partition AS partition, kafka_offset AS "offset" FROM telemetry',
)
def o9(spark, sf):
    """Every record delivered twice."""
    records = change_topic(telemetry(spark, sf))
    path = scratch_path(spark, "topic")
    records.unionByName(records).write.parquet(path)
    stream = read_envelope(spark, path, streaming=True, max_files=100)
    names = {"topic": "kafka_topic", "partition": "kafka_partition", "offset": "kafka_offset"}
    target, log = scratch_path(spark, "once"), scratch_path(spark, "offset-log")
    renamed = stream.withColumnsRenamed(names)
    drained(replay.start_once(renamed, target, log, scratch_path(spark, "checkpoint")))
    once = replay.read_once(spark, target, log, renamed.schema)
    return once.select(*(F.col(new).alias(old) for old, new in names.items()))


@query(
    "o10_scheduled_run",
    f"SELECT {OFFSETS}, device_id FROM bronze",
)
def o10(spark, sf):
    """Two scheduled runs over one checkpoint; the second sees only what arrived in between."""
    raw = scratch_path(spark, "raw")
    target, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    everything = _raw(spark, sf)
    until = instant(LOADED_UNTIL)
    for part in (F.col("ingested_at") <= until, F.col("ingested_at") > until):
        everything.where(part).write.mode("append").parquet(raw)
        drained(jobs.start_bronze(spark, raw, target, checkpoint, jobs.ONCE))
    return spark.read.parquet(target).select("kafka_partition", "kafka_offset", "device_id")


@query("o11_archive_stream", HOUR_FOLDERS)
def o11_archive(spark, sf):
    source, target = scratch_path(spark, "published"), scratch_path(spark, "archive")
    published(readings_of(spark, sf)).write.parquet(source)
    stream = spark.readStream.schema(TELEMETRY).parquet(source)
    drained(*jobs.start_archive(stream, target, scratch_path(spark, "checkpoint")))
    return _archived_events(spark, target)


@query(
    "o11_dead_letter_stream",
    f"""SELECT CASE WHEN error IS NULL THEN 'valid' ELSE 'dead_letter' END AS part, COUNT(*) AS records
FROM (SELECT {INGRESS_SQL} AS error FROM (SELECT *, {MISSING_SQL} AS missing FROM telemetry) AS listed) AS judged GROUP BY 1""",
)
def o11_dead_letters(spark, sf):
    path = topic_files(spark, _published_topic(spark, sf))
    good, bad = scratch_path(spark, "valid"), scratch_path(spark, "dead-letter")
    stream = read_envelope(spark, path, streaming=True)
    drained(
        *jobs.start_dead_letters(
            stream, good, bad, scratch_path(spark, "checkpoint"), cfg=CFG, as_of=AS_OF
        )
    )
    parts = [
        spark.read.parquet(where).select(F.lit(name).alias("part"))
        for name, where in (("valid", good), ("dead_letter", bad))
    ]
    return parts[0].unionByName(parts[1]).groupBy("part").agg(F.count("*").alias("records"))


@query(
    "l6_throttled_stream",
    """SELECT anomaly_type, region, time_bucket(INTERVAL '4' HOUR, event_timestamp) AS interval_start,
  MIN(event_timestamp) AS notified_at, COUNT(*) AS alert_count FROM anomalies GROUP BY 1, 2, 3""",
)
def l6_stream(spark, sf):
    path = scratch_path(spark, "anomalies")
    anomalies_of(spark, sf).repartitionByRange(stream_files(spark), "event_timestamp").write.parquet(path)
    stream = spark.readStream.schema(ANOMALIES).option("maxFilesPerTrigger", half(spark)).parquet(path)
    group = ["anomaly_type", "region"]
    notices = aggregates.throttled_notices(stream, group)
    return _run_updates(spark, notices, [*group, "interval_start"], "interval_start", "notices")


@query("l6_repeat_stream", _notices_sql("anomaly_type, region", "severity"))
def l6_repeat_stream(spark, sf):
    """Alerts in files of no order, a part of them delivered again."""
    path, found = scratch_path(spark, "anomalies"), anomalies_of(spark, sf)
    files = found.unionByName(found.where("anomaly_type = 'TEMP_SPIKE'")).repartition(stream_files(spark))
    files.write.parquet(path)
    stream = spark.readStream.schema(ANOMALIES).option("maxFilesPerTrigger", half(spark)).parquet(path)
    route, kept = Route(("anomaly_type", "region"), "severity"), scratch_path(spark, "notices")
    step = notice_step(scratch_path(spark, "kept-alerts"), kept, route, ["anomaly_id"])
    drained(jobs.start_batches(stream, step, scratch_path(spark, "checkpoint")))
    return _notice_values(read_newest(spark, kept, route.schema(found)))
