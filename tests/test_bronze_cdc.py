from datetime import datetime

from pyspark.sql import functions as F

from pulselake.operators.bronze import bronze
from pulselake.operators.cdc import apply_changes, rename_change_time, route, unwrap_cdc
from pulselake.sources.topics import read_cdc, read_telemetry
from tests.frames import rows


def raw(spark, *documents):
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, doc string")
    return frame.select(
        F.parse_json(F.format_string('{"offset":%d,"partition":3,"topic":"t"}', "i")).alias(
            "record_metadata"
        ),
        F.try_parse_json("doc").alias("record_content"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )


def test_missing_device_is_dropped_but_json_null_stays(spark):
    frame = raw(
        spark,
        '{"device_id":"a","__op":"c"}',
        '{"device_id":null,"__op":"c"}',
        '{"__op":"c"}',
        None,
        '{"device_id":"b","__op":"d"}',
        '{"device_id":"b"}',
        "{broken",
    )
    assert rows(bronze(frame), "kafka_offset", "device_id") == [(0, "a"), (1, None)]


def test_casts(spark):
    frame = raw(
        spark,
        '{"device_id":"a","__op":"c","battery":"12","is_online":"true","temperature":"hot"}',
        '{"device_id":"a","__op":"r","signal_strength":-40,"cdc_timestamp_ms":5,"__ts_ms":6}',
        '{"device_id":"a","__op":"u","__ts_ms":6}',
    )
    got = rows(
        bronze(frame),
        "kafka_offset",
        "battery",
        "is_online",
        "temperature",
        "signal_strength",
        "cdc_timestamp_ms",
    )
    assert got == [
        (0, 12.0, True, None, None, None),
        (1, None, None, None, -40, 5),
        (2, None, None, None, None, 6),
    ]


def test_event_time_is_utc(spark):
    times = [
        "2024-01-01T05:30:00+05:30",
        "2024-01-01 00:00:00",
        "2024-01-01T00:00:00.25Z",
        "not a time",
    ]
    frame = raw(
        spark, *(f'{{"device_id":"a","__op":"c","event_timestamp":"{t}"}}' for t in times)
    )
    start = datetime(2024, 1, 1)
    assert [r[1] for r in rows(bronze(frame), "kafka_offset", "event_timestamp")] == [
        start,
        start,
        start.replace(microsecond=250000),
        None,
    ]


IMAGE = "struct<device_id string, temperature double>"


def test_unwrap_insert_update_delete_tombstone(spark):
    schema = f"o bigint, before {IMAGE}, after {IMAGE}, op string, source struct<table string>, ts_ms bigint"
    frame = spark.createDataFrame(
        [
            (1, None, ("d", 1.0), "c", ("iot_events",), 10),
            (2, ("d", 1.0), ("d", 2.0), "u", ("iot_events",), 11),
            (3, ("d", 2.0), None, "d", ("iot_events",), 12),
            (4, None, None, None, None, None),
        ],
        schema,
    )
    flat = rename_change_time(unwrap_cdc(frame))
    assert rows(flat, "o", "device_id", "temperature", "__op", "cdc_timestamp_ms", "__deleted") == [
        (1, "d", 1.0, "c", 10, False),
        (2, "d", 2.0, "u", 11, False),
        (3, "d", 2.0, "d", 12, True),
        (4, None, None, None, None, None),
    ]


def test_apply_changes_and_route(spark):
    frame = spark.createDataFrame(
        [
            ("a", 1, "c", "iot_events"),
            ("a", 2, "d", "iot_events"),
            ("b", 1, "c", "iot_events"),
            ("b", 3, "u", "iot_events"),
            ("c", 5, "d", "iot_events"),
            ("c", 6, "c", "device_alerts"),
        ],
        "k string, o int, cdc_operation string, source_table string",
    )
    assert rows(apply_changes(frame, ["k"], [F.desc("o")]), "k", "o") == [("b", 3), ("c", 6)]
    assert rows(route(frame, "device_alerts"), "k") == [("c",)]


def test_topic_files(spark, tmp_path):
    spark.createDataFrame(
        [
            ("a", '{"device_id":"a","__op":"r","__table":"iot_events","__ts_ms":7}', "t", 0, 1),
            ("a", "{oops", "t", 0, 2),
            ("a", None, "t", 0, 3),
        ],
        "key string, value string, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.current_timestamp()).write.parquet(str(tmp_path / "t"))
    path = str(tmp_path / "t")
    parsed = read_telemetry(spark, path).select("offset", F.col("payload").isNull().alias("empty"))
    assert rows(parsed, "*") == [(1, False), (2, True), (3, True)]
    assert rows(read_cdc(spark, path), "offset", "op", "source_table", "cdc_timestamp_ms") == [
        (1, "r", "iot_events", 7),
        (2, None, None, None),
        (3, None, None, None),
    ]
