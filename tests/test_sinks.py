import glob

from pyspark.sql import functions as F

from pulselake.operators import checks
from pulselake.operators.measures import TELEMETRY_MEASURES, telemetry_measures
from pulselake.operators.registry import refresh_registry, seed_registry
from pulselake.sinks.archive import dead_letter_path, write_archive
from pulselake.sinks.dead_letter import split_dead_letters
from pulselake.sinks.measures import ensure_table, write_measures
from pulselake.sinks.relational import collapse, relational_rows, upsert_relational
from pulselake.sinks.tables import align_schema, rebuild, retention_filter, storage_tier
from pulselake.schemas import ENVELOPE
from pulselake.sources.archive import read_archive
from pulselake.sources.derived import published, telemetry
from tests.conftest import SF
from tests.frames import readings, rows, same

GOOD = (
    '{"device_id":"a","latitude":1,"longitude":2,"timestamp":"2024-01-01T00:00:00+00:00",'
    '"temperature":20,"humidity":50,"battery":5,"signal_strength":-40}'
)


def envelope(spark, *values):
    data = [("k", v, "events", 0, i) for i, v in enumerate(values)]
    names = "key string, value string, topic string, partition int, offset bigint"
    frame = spark.createDataFrame(data, names)
    return frame.withColumn("timestamp", F.current_timestamp()).select(*ENVELOPE.fieldNames())


def test_dead_letters_keep_payload_reason_and_position(spark):
    hot = GOOD.replace('"temperature":20', '"temperature":99')
    short = GOOD.replace('"battery":5,', "")
    frame = envelope(spark, GOOD, hot, short, "{broken")
    valid, dead = split_dead_letters(frame, as_of="2024-01-01 00:00:00")
    assert rows(valid, "offset", "value") == [(0, GOOD)]
    assert rows(dead, "offset", "error", "original_payload") == [
        (1, "Temperature out of sensor range: 99.0", hot),
        (2, "Missing fields: battery", short),
        (3, "Malformed JSON", "{broken"),
    ]


def test_archive_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "archive")
    events = published(telemetry(spark, SF)).where("timestamp IS NOT NULL")
    write_archive(events, path)
    assert glob.glob(f"{path}/year=2024/month=01/day=05/hour=0*/*.snappy")
    back = read_archive(spark, path).drop("year", "month", "day", "hour")
    assert same(back, events)
    one = read_archive(spark, path, "2024-01-05 03:30:00", "2024-01-05 04:00:00")
    assert rows(one.select("day", "hour").distinct(), "day", "hour") in ([(5, 3), (5, 4)], [(5, 3)], [(5, 4)])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "make_timestamp" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_archive_and_its_dead_letters_hold_every_event(spark, tmp_path):
    path = str(tmp_path / "archive")
    events = published(telemetry(spark, SF)).where("device_id = 'device_0013' AND timestamp LIKE '2024-%'")
    broken = events.withColumn("timestamp", F.lit("yesterday")).unionByName(
        events.withColumn("timestamp", F.lit(None).cast("string"))
    )
    write_archive(events.unionByName(broken), path)
    n = events.count()
    letters = spark.read.parquet(dead_letter_path(path)).collect()
    assert len(letters) == 2 * n and {r["error"] for r in letters} == {"No readable event time"}
    assert all('"device_id"' in r["original_payload"] for r in letters)
    assert read_archive(spark, path).count() == n


def test_measures_are_counted_and_rejected(spark, tmp_path):
    path = str(tmp_path / "measures")
    frame = spark.createDataFrame(
        [("a", 1.0, 5), ("a", None, 5), ("b", 2.0, None)],
        "measure_name string, measure_value double, time bigint",
    )
    ensure_table(frame, path)
    assert write_measures(frame, path) == {"written": 1, "rejected": 2}
    ensure_table(frame, path)
    assert spark.read.parquet(path).count() == 1


def test_null_measures_are_skipped(spark):
    names = ["device_id", "region", *TELEMETRY_MEASURES.values()]
    kinds = ", ".join(f"{n} {'string' if n in ('device_id', 'region') else 'double'}" for n in names)
    frame = spark.createDataFrame([("d", None, 1.0, 2.0, None, 4.0, None, 6.0, 7.0)], kinds)
    got = telemetry_measures(frame, "1970-01-01 00:00:01")
    assert rows(got, "measure_name", "measure_value", "region", "time") == [
        ("avg_humidity", 4.0, "unknown", 1000),
        ("avg_signal", 7.0, "unknown", 1000),
        ("avg_temperature", 1.0, "unknown", 1000),
        ("battery_drain", 6.0, "unknown", 1000),
        ("max_temperature", 2.0, "unknown", 1000),
    ]


def test_relational_rows(spark):
    frame = published(
        readings(spark, {}, {"temperature": 30.0}).withColumns(
            {"model": F.lit("m"), "firmware_version": F.lit("v")}
        )
    )
    got = collapse(relational_rows(frame, "2024-01-11 00:00:00"))
    assert got.count() == 1
    assert "timestamp" not in got.columns and "model" not in got.columns


def test_older_versions_never_replace_newer_relational_rows(spark, tmp_path):
    def batch(*versions):
        made = readings(
            spark, *({"device_id": d, "event_timestamp": t, "temperature": v, "kafka_offset": o} for d, t, v, o in versions)
        ).withColumns({"model": F.lit("m"), "firmware_version": F.lit("v")})
        return relational_rows(published(made, "kafka_offset"), "2024-01-11 00:00:00", ["kafka_offset"])

    day = "2024-01-10 12:00:00"
    newer = batch(("a", day, 2.0, 20), ("a", day, 1.0, 10), ("b", day, 5.0, 3), ("c", None, 9.0, 4))
    older = batch(("a", day, 0.0, 15), ("b", day, 6.0, 5), (None, day, 9.0, 30))
    want = [(None, 9.0, 30), ("a", 2.0, 20), ("b", 6.0, 5)]
    for name, order in (("one", (newer, older)), ("two", (older, newer)), ("again", (newer, older, newer, older))):
        path = str(tmp_path / name)
        for part in order:
            upsert_relational(part, path, ["kafka_offset"])
        assert rows(spark.read.parquet(path), "device_id", "temperature", "kafka_offset") == want


def test_schema_retention_and_tiers(spark, tmp_path):
    frame = readings(spark, {}, {"event_timestamp": "2024-01-01 00:00:00", "kafka_offset": 2})
    wanted = frame.select("device_id", F.lit(1).alias("new")).schema
    assert rows(align_schema(frame.select("device_id", "region"), wanted).distinct(), "*") == [
        ("device_0001", None)
    ]
    kept = retention_filter(frame, "event_timestamp", 7, "2024-01-12 00:00:00")
    assert rows(kept, "kafka_offset") == [(1,)]
    dated = frame.withColumn("event_date", F.to_date("event_timestamp"))
    tiers = dated.select("event_date", storage_tier("event_date", "2024-04-08 00:00:00").alias("t"))
    assert rows(tiers, "t") == [("infrequent",), ("standard",)]

    path = str(tmp_path / "gold")
    rebuild(dated, path, "event_date", ["region"])
    rebuild(dated.where("kafka_offset = 1"), path, "event_date", ["region"])
    assert spark.read.parquet(path).count() == 1


def test_registry(spark):
    seeds = seed_registry(spark, 6, "2024-01-01 00:00:00")
    assert rows(seeds.where("device_id = 'device_0006'"), "region", "model", "firmware_version") == [
        ("los_angeles", "TempSensor-Pro", "v1.6.0")
    ]
    seen = readings(
        spark,
        {"event_timestamp": "2024-01-10 10:00:00", "region": "chicago"},
        {"event_timestamp": "2024-01-10 09:00:00", "region": "miami"},
        {"device_id": "device_9999"},
    ).withColumns({"model": F.lit("m"), "firmware_version": F.lit("v9")})
    fresh = refresh_registry(seeds, seen)
    assert fresh.count() == 6
    assert rows(fresh.where("last_seen_at IS NOT NULL"), "device_id", "region", "firmware_version") == [
        ("device_0001", "chicago", "v9")
    ]
    again = refresh_registry(fresh, seen.where("region = 'miami'"))
    assert rows(again.where("device_id = 'device_0001'"), "region") == [("chicago",)]


def test_checks_find_and_pass(spark):
    frame = readings(
        spark,
        {"kafka_offset": 1},
        {"kafka_offset": 2, "humidity": None, "device_id": "ab"},
        {"kafka_offset": 3, "cdc_operation": "x", "latitude": 91.0},
    )

    def hit(df):
        return [r[0] for r in rows(df, "kafka_offset")]

    assert hit(checks.check_not_null(frame, checks.BRONZE_NOT_NULL)) == [2]
    assert hit(checks.check_length(frame, "device_id", *checks.KEY_LENGTH)) == [2]
    assert hit(checks.check_between(frame, checks.value_ranges())) == [3]
    assert hit(checks.check_accepted(frame, "cdc_operation", checks.ACCEPTED_OPERATIONS)) == [3]
    assert hit(checks.check_coordinates(frame)) == [3]
    assert hit(checks.check_times(frame, "2024-01-10 00:00:00")) == [1, 2, 3]
    assert rows(checks.check_unique(frame, ["device_id", "event_timestamp"]), "row_count") == [(2,)]
    parents = frame.where("kafka_offset = 1").select("device_id")
    assert hit(checks.check_foreign_key(frame, parents, "device_id")) == [2]
    assert checks.check_row_count(frame, 3).isEmpty()
    assert rows(checks.check_row_count(frame, 4), "row_count") == [(3,)]
