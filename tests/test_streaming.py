from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulselake.operators.anomalies import anomalies
from pulselake.operators.bronze import bronze
from pulselake.operators.silver import silver
from pulselake.operators.summary import device_summary
from pulselake.plans.medallion import Lake
from pulselake.schemas import ANOMALIES, SILVER, SUMMARY
from pulselake.sources.derived import raw_landing, telemetry
from pulselake.sources.tables import read_table
from pulselake.streaming import aggregates, jobs
from tests.conftest import SF
from tests.frames import rows, same, silver_rows

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def parts(spark):
    """Raw rows in three slices of ingest time."""
    raw = raw_landing(telemetry(spark, SF))
    cuts = ["2000-01-01", "2024-01-10", "2024-01-20", "2100-01-01"]
    when = F.col("ingested_at")
    return [
        raw.where((when > F.lit(a).cast("timestamp_ntz")) & (when <= F.lit(b).cast("timestamp_ntz")))
        for a, b in zip(cuts, cuts[1:])
    ]


def readings(spark, *times, **change):
    return silver_rows(spark, *({"event_timestamp": f"2024-01-10 {t}", **change} for t in times))


def stream_of(spark, path):
    return spark.readStream.schema(SILVER).parquet(str(path))


def arrive(df, path):
    df.write.mode("append").parquet(str(path))


def test_silver_stream_with_restarts(spark, parts, tmp_path):
    """Files arrive between runs; each run resumes from the checkpoint."""
    raw, lake = str(tmp_path / "raw"), Lake(str(tmp_path / "lake"))
    target = str(tmp_path / "rapid")
    for part in parts:
        arrive(part, raw)
        job = jobs.start_silver(
            spark,
            raw,
            lake,
            str(tmp_path / "checkpoint"),
            as_of=AS_OF,
            then=[jobs.rapid_change_step(lake, target, as_of=AS_OF)],
        )
        job.awaitTermination()
    expected = silver(bronze(spark.read.parquet(raw)), as_of=AS_OF)
    assert same(lake.read_silver(spark), expected)

    # The same files delivered again change nothing.
    arrive(parts[0], raw)
    jobs.start_silver(spark, raw, lake, str(tmp_path / "checkpoint"), as_of=AS_OF).awaitTermination()
    assert same(lake.read_silver(spark), expected)


def test_rapid_changes_across_batches_and_late_rows(spark, tmp_path):
    from pulselake.operators.upsert import upsert

    lake, target = Lake(str(tmp_path / "lake")), str(tmp_path / "rapid")
    step = jobs.rapid_change_step(lake, target, as_of=AS_OF)
    batches = [
        readings(spark, "09:58:00", temperature=10.0),
        readings(spark, "10:01:00", temperature=30.0),  # across the hour and the batch
        readings(spark, "10:30:00", temperature=60.0),
        readings(spark, "10:27:00", temperature=45.0),  # late: before the reading above
        readings(spark, "11:00:00", temperature=10.0),
        readings(spark, "11:04:00", temperature=30.0),  # raised now, retracted by the next one
        readings(spark, "11:02:00", temperature=25.0),
    ]
    for n, batch in enumerate(batches):
        upsert(batch, lake.silver, ["device_id", "event_timestamp"], "event_date")
        step(batch, n)
    streamed = jobs.read_raised(spark, target)
    whole = lake.read_silver(spark)
    batch_form = anomalies(whole, device_summary(whole), as_of=AS_OF).where(
        "anomaly_type = 'RAPID_TEMP_CHANGE'"
    )
    assert rows(streamed, F.date_format("event_timestamp", "HH:mm")) == [
        ("10:01",),
        ("10:30",),
        ("11:02",),
    ]
    assert same(streamed, batch_form)


def test_append_windows_in_order_drop_only_late_rows(spark, tmp_path):
    source, target = tmp_path / "source", str(tmp_path / "target")

    def step(frame):
        arrive(frame, source)
        stream = aggregates.five_minute_temperature(stream_of(spark, source))
        jobs.start_append(stream, target, str(tmp_path / "checkpoint")).awaitTermination()
        return rows(spark.read.schema(stream.schema).parquet(target), "time_bin", "avg_temp")

    step(readings(spark, "10:00:30", "10:01:00", temperature=10.0))
    step(readings(spark, "10:02:00", "10:20:00", temperature=40.0))
    # The first window is closed by now; a row for it is dropped.
    got = step(readings(spark, "10:03:00", "10:45:00", temperature=99.0))
    assert got == [
        (datetime(2024, 1, 10, 10, 0), 20.0),
        (datetime(2024, 1, 10, 10, 20), 40.0),
    ]


def test_summary_stream_equals_batch(spark, parts, tmp_path):
    """Three arrivals, in order and shuffled, give the batch summary."""
    clean = silver(bronze(parts[0].union(parts[1]).union(parts[2])), as_of=AS_OF)
    clean.write.parquet(str(tmp_path / "clean"))
    clean = spark.read.schema(SILVER).parquet(str(tmp_path / "clean"))
    source, target = tmp_path / "source", str(tmp_path / "summary")
    for n in range(3):
        arrive(clean.where(F.pmod(F.xxhash64("device_id", "event_timestamp"), F.lit(3)) == n), source)
        jobs.start_summary(
            stream_of(spark, source), target, str(tmp_path / "checkpoint"), lateness="60 days"
        ).awaitTermination()
    assert same(spark.read.schema(SUMMARY).parquet(target), device_summary(clean))


def test_gold_steps_lose_no_late_row(spark, parts, tmp_path):
    """Newest first, so that every later batch lies weeks behind the one before it."""
    raw, lake = str(tmp_path / "raw"), Lake(str(tmp_path / "lake"))
    trend, summary = str(tmp_path / "trend"), str(tmp_path / "summary")

    def hourly(frame):
        return aggregates.hourly_trend(frame).withColumn("event_date", F.to_date("hour"))

    old = parts[0].withColumn(
        "payload", F.regexp_replace("payload", "2024-01-", "2023-06-")
    ) if "payload" in parts[0].columns else parts[0]
    for part in (parts[2], old, parts[1]):
        arrive(part, raw)
        steps = [jobs.gold_step(lake, trend, hourly), jobs.gold_step(lake, summary, device_summary, ["region"])]
        jobs.start_silver(spark, raw, lake, str(tmp_path / "checkpoint"), as_of=AS_OF, then=steps).awaitTermination()
    clean = silver(bronze(spark.read.parquet(raw)), as_of=AS_OF)
    assert same(spark.read.schema(SUMMARY).parquet(summary), device_summary(clean))
    want = hourly(clean)
    assert same(spark.read.schema(want.schema).parquet(trend), want)


def test_alert_streams(spark, tmp_path):
    source = tmp_path / "source"
    arrive(readings(spark, "10:00:00", battery=5.0, is_online=False), source)
    arrive(readings(spark, "11:00:00", temperature=55.0), source)
    found, critical = str(tmp_path / "found"), str(tmp_path / "critical")
    stream = stream_of(spark, source)
    jobs.start_alerts(stream, found, str(tmp_path / "c1"), as_of=AS_OF).awaitTermination()
    jobs.start_critical_readings(stream, critical, str(tmp_path / "c2")).awaitTermination()
    assert rows(spark.read.schema(ANOMALIES).parquet(found), "anomaly_type") == [
        ("BATTERY_CRITICAL",),
        ("DEVICE_OFFLINE",),
    ]
    assert spark.read.schema(SILVER).parquet(critical).count() == 2


def test_spikes_use_the_newest_statistics(spark, tmp_path):
    lake, target = Lake(str(tmp_path / "lake")), str(tmp_path / "spikes")
    step = jobs.spike_step(lake, target, as_of=AS_OF)

    def summary(mean):
        days = [("device_0001", f"2024-01-{d:02d}", mean + d / 10) for d in range(7, 11)]
        frame = spark.createDataFrame(days, "device_id string, d string, avg_temperature double")
        frame.select(
            F.col("d").cast("date").alias("event_date"),
            "device_id",
            "avg_temperature",
            F.lit(5).cast("bigint").alias("total_events"),
        ).write.mode("overwrite").parquet(lake.summary)

    summary(40.0)
    step(readings(spark, "10:00:00", temperature=30.0), 0)
    assert read_table(spark, target, ANOMALIES).isEmpty()
    summary(20.0)
    step(readings(spark, "11:00:00", temperature=30.0), 1)
    assert rows(read_table(spark, target, ANOMALIES), F.hour("event_timestamp")) == [(11,)]


def test_valid_readings_are_stateless(spark, tmp_path):
    source = tmp_path / "source"
    arrive(readings(spark, "10:00:00"), source)
    stream = jobs.valid_readings(
        stream_of(spark, source).withColumn("cdc_timestamp_ms", F.lit(1)), as_of=AS_OF
    )
    target = str(tmp_path / "target")
    jobs.start_append(stream, target, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.schema(SILVER).parquet(target).count() == 1
