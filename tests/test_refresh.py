"""Gold kept up to date by change equals Gold built whole."""

import pytest
from pyspark.sql import functions as F

from pulselake.config import Config
from pulselake.operators.anomalies import anomalies
from pulselake.operators.bronze import bronze
from pulselake.operators.summary import device_summary
from pulselake.plans.medallion import Lake, load_silver, refresh_step, run
from pulselake.plans.refresh import affected_days, refresh_gold
from pulselake.schemas import ANOMALIES, SUMMARY
from pulselake.sinks.tables import rebuild
from pulselake.sources.derived import raw_landing, telemetry
from tests.conftest import SF
from tests.frames import same, silver_rows

AS_OF = "2024-02-01 00:00:00"


def whole(spark, lake):
    """Gold of the lake's Silver, built in one go."""
    silver = lake.read_silver(spark)
    summary = device_summary(silver)
    return summary, anomalies(silver, summary, as_of=AS_OF)


def test_loads_in_any_order(spark, tmp_path):
    """Every load has late and corrected readings on days that have Gold already."""
    lake = Lake(str(tmp_path / "lake"))
    readings = bronze(raw_landing(telemetry(spark, SF)))
    share = F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(3))
    for part in (2, 0, 1):
        load_silver(readings.where(share == part), lake, as_of=AS_OF, then=[refresh_step(lake, as_of=AS_OF)])
    summary, found = whole(spark, lake)
    assert found.count() > 100
    assert same(lake.read_summary(spark), summary.select(*SUMMARY.fieldNames()))
    assert same(lake.read_anomalies(spark), found.select(*ANOMALIES.fieldNames()))


def gold_of(spark, tmp_path, silver):
    paths = str(tmp_path / "summary"), str(tmp_path / "anomalies")
    summary = device_summary(silver)
    rebuild(summary, paths[0], "event_date", ["region"])
    rebuild(anomalies(silver, summary, as_of=AS_OF), paths[1], "event_date", ["anomaly_type"])
    return paths


def test_only_anomaly_of_a_day_goes(spark, tmp_path):
    """The corrected reading leaves its day without an anomaly, its region without a summary row."""
    at = {"event_timestamp": "2024-01-10 10:00:00"}
    other = {"event_timestamp": "2024-01-11 10:00:00", "battery": 3.0}
    before = silver_rows(spark, {**at, "battery": 3.0, "region": "miami"}, other)
    after = silver_rows(spark, {**at, "battery": 90.0, "region": "chicago"}, other)
    summary, found = gold_of(spark, tmp_path, before)
    touched = after.where("event_date = DATE'2024-01-10'")
    for _ in range(2):
        refresh_gold(after, summary, found, touched, as_of=AS_OF)
        stored = spark.read.schema(ANOMALIES).parquet(found)
        assert [str(r.event_date) for r in stored.select("event_date").distinct().collect()] == ["2024-01-11"]
        assert same(spark.read.schema(SUMMARY).parquet(summary), device_summary(after).select(*SUMMARY.fieldNames()))


def test_nothing_touched(spark, tmp_path):
    silver = silver_rows(spark, {"event_timestamp": "2024-01-10 10:00:00", "battery": 3.0})
    summary, found = gold_of(spark, tmp_path, silver)
    kept = spark.read.parquet(found).count()
    refresh_gold(silver, summary, found, silver.limit(0), as_of=AS_OF)
    assert spark.read.parquet(found).count() == kept > 0


@pytest.mark.parametrize("rows,reached", [(7, range(3, 10)), (1, range(3, 5))])
def test_how_far_a_change_reaches(spark, rows, reached):
    """As many rows of the device as the frame has, whatever the days between them."""
    days = [(f"d{d}", f"2024-0{m}-01") for d in (1, 2) for m in range(1, 10)] + [("d1", "2024-10-01"), ("d1", "2024-11-01")]
    summary = spark.createDataFrame(days, "device_id string, day string").select(
        "device_id", F.to_date("day").alias("event_date")
    )
    touched = summary.where("device_id = 'd1' AND event_date = DATE'2024-03-01'")
    got = affected_days(summary, touched, Config(rolling_rows=rows))
    assert {r.event_date.month for r in got.where("affected").collect()} == set(reached)
    assert {(r.device_id, r.event_date.month) for r in got.where("NOT affected").collect()} == {("d1", 2)}


def test_runs_keep_gold_up_to_date(spark, tmp_path):
    raw = raw_landing(telemetry(spark, SF))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    lake = Lake(str(tmp_path / "lake"))
    run(raw.where(F.col("ingested_at") <= cut), lake, as_of=AS_OF)
    run(raw, lake, as_of=AS_OF)
    run(raw, lake, as_of=AS_OF)
    summary, found = whole(spark, lake)
    assert same(lake.read_summary(spark), summary.select(*SUMMARY.fieldNames()))
    assert same(lake.read_anomalies(spark), found.select(*ANOMALIES.fieldNames()))
