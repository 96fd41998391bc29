import pytest
from pyspark.sql import functions as F

from pulselake.config import Config
from pulselake.functions.quality import (
    battery_health,
    ingress_error,
    quality_status,
    signal_quality,
)
from pulselake.operators.silver import classify, quarantine, silver
from tests.frames import readings, rows

AS_OF = "2024-02-01 00:00:00"


def status(spark, **change):
    return readings(spark, change).select(quality_status(Config(), AS_OF)).first()[0]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, "VALID"),
        ({"device_id": None, "latitude": None}, "NULL_DEVICE_ID"),
        ({"latitude": None}, "NULL_LATITUDE"),
        ({"longitude": None}, "NULL_LONGITUDE"),
        ({"temperature": None}, "NULL_TEMPERATURE"),
        ({"latitude": 90.0}, "VALID"),
        ({"latitude": 90.0001}, "INVALID_LATITUDE"),
        ({"latitude": -90.0}, "VALID"),
        ({"longitude": -180.0}, "VALID"),
        ({"longitude": -180.5, "temperature": 99.0}, "INVALID_LONGITUDE"),
        ({"temperature": -50.0}, "VALID"),
        ({"temperature": -50.01}, "TEMPERATURE_OUT_OF_RANGE"),
        ({"temperature": 80.0}, "VALID"),
        ({"temperature": 80.01}, "TEMPERATURE_OUT_OF_RANGE"),
        ({"temperature": float("nan")}, "TEMPERATURE_OUT_OF_RANGE"),
        ({"humidity": None, "battery": None}, "VALID"),
        ({"humidity": 0.0}, "VALID"),
        ({"humidity": 100.01}, "HUMIDITY_OUT_OF_RANGE"),
        ({"battery": -0.01}, "BATTERY_OUT_OF_RANGE"),
        ({"event_timestamp": None}, "NULL_TIMESTAMP"),
        ({"event_timestamp": AS_OF}, "VALID"),
        ({"event_timestamp": "2024-02-01 00:00:01"}, "FUTURE_TIMESTAMP"),
        ({"event_timestamp": "2020-01-01 00:00:00"}, "VALID"),
        ({"event_timestamp": "2019-12-31 23:59:59"}, "TIMESTAMP_TOO_OLD"),
    ],
)
def test_first_broken_rule(spark, change, expected):
    assert status(spark, **change) == expected


def test_classes(spark):
    levels = [9.99, 10.0, 19.99, 20.0, 20.01, None]
    frame = readings(spark, *({"battery": b, "kafka_offset": i} for i, b in enumerate(levels)))
    got = [r[0] for r in frame.orderBy("kafka_offset").select(battery_health()).collect()]
    assert got == ["critical", "warning", "warning", "healthy", "healthy", "healthy"]

    dbm = [-49, -50, -69, -70, -84, -85, -91, None]
    frame = readings(spark, *({"signal_strength": s, "kafka_offset": i} for i, s in enumerate(dbm)))
    got = [r[0] for r in frame.orderBy("kafka_offset").select(signal_quality()).collect()]
    assert got == ["excellent", "good", "good", "fair", "fair", "poor", "poor", "poor"]


def test_ingress_reasons(spark):
    frame = readings(
        spark,
        {"kafka_offset": 0},
        {"kafka_offset": 1, "battery": 150.0},
        {"kafka_offset": 2, "latitude": 91.0, "temperature": 99.0},
        {"kafka_offset": 3, "humidity": None, "battery": None},
    ).withColumn("timestamp", F.col("event_timestamp"))
    got = [r[0] for r in frame.orderBy("kafka_offset").select(ingress_error()).collect()]
    assert got == [None, None, "Invalid latitude: 91.0", "Missing fields: battery, humidity"]


def test_ingress_tells_missing_from_null(spark):
    frame = spark.sql(
        """SELECT parse_json('{"device_id":"d","latitude":null,"longitude":1,"timestamp":"t",
        "temperature":1,"humidity":1,"battery":1,"signal_strength":-1}') AS payload,
        CAST(NULL AS double) AS latitude, 1D AS longitude, 1D AS temperature, 1D AS humidity"""
    )
    assert frame.select(ingress_error(payload=F.col("payload"))).first()[0] == "Invalid latitude: null"


def test_invalid_newest_version_hides_valid_one(spark):
    frame = readings(
        spark, {"kafka_offset": 1}, {"kafka_offset": 2, "temperature": 99.0, "cdc_operation": "u"}
    )
    assert silver(frame, as_of=AS_OF).isEmpty()
    assert rows(quarantine(frame, as_of=AS_OF), "kafka_offset", "rejection_reason") == [
        (2, "TEMPERATURE_OUT_OF_RANGE")
    ]


def test_tied_offsets_are_settled(spark):
    frame = readings(
        spark,
        {"kafka_partition": 1, "temperature": 1.0},
        {"kafka_partition": 2, "temperature": 2.0},
        {"kafka_partition": 0, "temperature": 3.0, "cdc_timestamp_ms": 0},
    )
    assert rows(classify(frame, as_of=AS_OF), "temperature") == [(2.0,)]


def test_null_keys_form_one_group(spark):
    nothing = {"device_id": None, "event_timestamp": None}
    frame = readings(spark, *({**nothing, "kafka_offset": i} for i in range(50)))
    assert rows(classify(frame, as_of=AS_OF), "kafka_offset") == [(49,)]
