from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulselake.config import Config
from pulselake.functions.numeric import plain_number, rounded_mean
from pulselake.functions.timeutil import minutes_crossed
from pulselake.operators.alerts import (
    alert_episodes,
    device_alerts,
    metric_alarm,
    resolve_alerts,
    throttle,
)
from pulselake.operators.anomalies import (
    anomalies,
    device_days,
    events_with_stats,
    rolling_stats,
    with_lag,
)
from pulselake.operators.dedup import READING_KEY
from pulselake.operators.silver import silver
from pulselake.operators.bronze import keep_operations
from pulselake.operators.summary import device_summary
from pulselake.operators.timeline import hot_days, with_neighbour
from pulselake.sources.derived import telemetry
from tests.frames import at, rows, same, silver_rows

AS_OF = "2024-02-01 00:00:00"
SF01 = "/root/testdata/sf0.01"


def day(time, **change):
    return {"event_timestamp": f"2024-01-10 {time}", **change}


def test_summary_of_one_day(spark):
    frame = silver_rows(
        spark,
        day("00:00:00", battery=50.0, temperature=10.0, is_online=None),
        day("09:30:00", battery=9.0, temperature=51.0, signal_strength=-60, humidity=None),
        day("09:45:00", battery=80.0, temperature=20.0, signal_strength=-90, is_online=False),
    )
    got = device_summary(frame).first()
    assert got.total_events == 3 and got.active_hours == 2
    assert got.uptime_pct == 33.33
    assert (got.avg_temperature, got.min_temperature, got.max_temperature) == (27.0, 10.0, 51.0)
    assert got.stddev_temperature == 21.3776
    assert got.avg_humidity == 50.0
    assert (got.battery_start_of_day, got.battery_end_of_day) == (50.0, 80.0)
    assert got.battery_drain_today == -30.0
    assert (got.had_high_temp_alert, got.had_critical_battery, got.had_offline_event) == (1, 1, 1)
    assert got.worst_battery_health == "critical"
    # 33.33 * 0.4 + 0.09 * 30 + 2/3 * 30 = 36.032
    assert got.device_health_score == 36.0


def test_single_event_day_and_unknown_battery(spark):
    got = device_summary(silver_rows(spark, day("01:00:00", battery=None, is_online=None))).first()
    assert got.stddev_temperature is None
    assert got.device_health_score is None
    assert got.had_offline_event == 0 and got.uptime_pct == 0.0


def test_worst_battery_orders(spark):
    frame = silver_rows(spark, day("01:00:00", battery=15.0), day("02:00:00", battery=90.0))
    assert device_summary(frame).first().worst_battery_health == "healthy"
    assert device_summary(frame, severity_order=True).first().worst_battery_health == "warning"


def test_means_do_not_depend_on_partitions(spark):
    frame = spark.range(20_000).select((F.rand(7) * 100).alias("x"), (F.col("id") % 3).alias("g"))
    frame = frame.select("g", F.round("x", 2).alias("x"))
    means = [
        rows(frame.repartition(n).groupBy("g").agg(rounded_mean(F.col("x"), 2).alias("m")), "g", "m")
        for n in (1, 7, 31)
    ]
    assert means[0] == means[1] == means[2]


@pytest.mark.parametrize(
    "values, digits, expected",
    [([0.005], 2, 0.01), ([-0.005], 2, -0.01), ([1.0, 2.0], 0, 2.0), ([0.001], 2, 0.0), ([], 2, None)],
)
def test_rounding_half_away_from_zero(spark, values, digits, expected):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert frame.agg(rounded_mean(F.col("x"), digits)).first()[0] == expected


def test_plain_number(spark):
    got = spark.range(1).select(*(plain_number(F.lit(x)) for x in (22.0, 22.5, -4.0))).first()
    assert tuple(got) == ("22", "22.5", "-4")


def test_minutes_are_boundaries(spark):
    pairs = [("00:00:59", "00:01:01", 1), ("00:00:00", "00:00:59", 0), ("00:00:30", "00:06:00", 6)]
    for start, end, expected in pairs:
        times = [F.lit(f"2024-01-01 {t}").cast("timestamp_ntz") for t in (start, end)]
        assert spark.range(1).select(minutes_crossed(*times)).first()[0] == expected


def lagged_by_window(df):
    w = Window.partitionBy("device_id").orderBy("event_timestamp")
    return df.withColumns(
        {
            "prev_temperature": F.lag("temperature").over(w),
            "prev_event_timestamp": F.lag("event_timestamp").over(w),
        }
    )


@pytest.fixture(scope="module")
def derived(spark):
    return silver(keep_operations(telemetry(spark, SF01)), as_of=AS_OF).cache()


def test_bucketed_lag_equals_window(spark, derived):
    readings = derived.select("device_id", "event_timestamp", "temperature")
    assert same(with_lag(readings), lagged_by_window(readings))


def test_one_device_holding_most_rows(spark, derived, tmp_path):
    """Two thirds of the rows on one device: hot days are split by minute, results stay."""
    skewed = derived.withColumn(
        "device_id", F.when(F.col("kafka_offset") % 3 < 2, "device_hot").otherwise(F.col("device_id"))
    ).dropDuplicates(READING_KEY)
    skewed.write.parquet(str(tmp_path / "skewed"))
    skewed = spark.read.parquet(str(tmp_path / "skewed"))
    cfg = replace(Config(), hot_share=0.01, hot_floor=0)
    summary = device_summary(skewed)
    hot = hot_days(summary, ["device_id"], "event_date", "total_events", cfg)
    assert 0 < hot.count() <= 100
    assert {r[0] for r in hot.select("device_id").collect()} == {"device_hot"}
    readings = skewed.select("device_id", "event_timestamp", "temperature")
    assert same(with_lag(readings, hot), lagged_by_window(readings))
    columns = ["device_id", "event_timestamp", "anomaly_type", "description"]
    assert same(
        anomalies(skewed, summary, cfg, AS_OF).select(columns),
        anomalies(skewed, summary, Config(), AS_OF).select(columns),
    )


def test_lead_is_the_mirror(spark, derived):
    readings = derived.select("device_id", "event_timestamp", "battery")
    w = Window.partitionBy("device_id").orderBy("event_timestamp")
    ahead = with_neighbour(readings, ["device_id"], "event_timestamp", ["battery"], forward=True)
    assert same(ahead, readings.withColumn("next_battery", F.lead("battery").over(w)))


def found(spark, *changes):
    frame = silver_rows(spark, *changes)
    return anomalies(frame, device_summary(frame), as_of=AS_OF)


def test_rule_limits(spark):
    frame = [
        day("01:00:00", battery=9.99),
        day("02:00:00", battery=10.0),
        day("03:00:00", battery=20.0),
        day("04:00:00", battery=20.01),
        day("05:00:00", signal_strength=-90),
        day("06:00:00", signal_strength=-91),
        day("07:00:00", is_online=False, battery=5.0),
        day("08:00:00", is_online=None, battery=None),
    ]
    got = rows(found(spark, *frame), F.hour("event_timestamp"), "anomaly_type", "description")
    assert got == [
        (1, "BATTERY_CRITICAL", "Battery critical at 9.99%"),
        (2, "BATTERY_WARNING", "Battery low at 10%"),
        (3, "BATTERY_WARNING", "Battery low at 20%"),
        (6, "SIGNAL_LOST", "Signal strength -91 dBm (below -90 threshold)"),
        (7, "BATTERY_CRITICAL", "Battery critical at 5%"),
        (7, "DEVICE_OFFLINE", "Device reported offline"),
    ]


def test_rapid_change_needs_size_and_time(spark):
    frame = [
        day("01:00:59", temperature=10.0),
        day("01:06:00", temperature=30.0),  # six boundaries: too late
        day("01:11:59", temperature=41.0),  # five boundaries, 11 degrees
        day("01:12:00", temperature=31.0),  # exactly 10 degrees
        day("01:59:58", temperature=30.0),
        day("02:00:01", temperature=50.0),  # crosses the hour
    ]
    got = rows(found(spark, *frame), "event_timestamp", "metric_value", "description")
    assert got == [
        (at("2024-01-10 01:11:59"), 11.0, "Temperature changed 11°C in 5 minutes"),
        (at("2024-01-10 02:00:01"), 20.0, "Temperature changed 20°C in 1 minutes"),
    ]


def test_spike_and_zero_deviation(spark):
    def flat(d, t):
        return {"event_timestamp": f"2024-01-{d:02d} 12:00:00", "temperature": t}

    steady = [flat(d, 20.0) for d in range(1, 8)]
    assert found(spark, *steady).isEmpty()
    # One hot reading among cool ones on the last of seven days with slightly moving means.
    moving = [flat(d, 20.0 + d / 10) for d in range(1, 8)]
    cool = [
        {"event_timestamp": f"2024-01-07 13:{m:02d}:00", "temperature": 19.0} for m in range(0, 60, 2)
    ]
    hot = {"event_timestamp": "2024-01-07 23:00:00", "temperature": 45.0}
    kinds = rows(found(spark, *moving, *cool, hot), "anomaly_type", "metric_value")
    assert ("TEMP_SPIKE", 45.0) in kinds


def test_two_regions_on_one_day_do_not_multiply(spark):
    frame = silver_rows(
        spark,
        day("01:00:00", region="miami", temperature=10.0),
        day("02:00:00", region="miami", temperature=10.0),
        day("03:00:00", region="chicago", temperature=40.0),
    )
    summary = device_summary(frame)
    assert summary.count() == 2
    assert rows(device_days(summary), "avg_temperature", "total_events") == [(20.0, 3)]
    assert events_with_stats(frame, summary).count() == 3


def test_rolling_rows_not_days(spark):
    days = spark.createDataFrame(
        [("d", f"2024-{m:02d}-01", float(m)) for m in range(1, 10)],
        "device_id string, event_date string, avg_temperature double",
    )
    got = rows(rolling_stats(days), "event_date", "rolling_7d_avg_temp")
    assert got[-1] == ("2024-09-01", 6.0)


def test_alert_lifecycle(spark):
    frame = silver_rows(
        spark,
        day("01:00:00", battery=5.0),
        day("01:30:00", battery=4.0),
        day("05:00:00", battery=50.0),
        day("06:00:00", is_online=False),
        day("07:00:00", is_online=False, temperature=60.0),
    )
    episodes = alert_episodes(frame)
    got = rows(episodes, "alert_type", F.hour("triggered_at"), F.hour("resolved_at"), "is_resolved")
    assert got == [
        ("high_temp", 7, None, False),
        ("low_battery", 1, 5, True),
        ("offline", 6, None, False),
    ]
    closing = episodes.where("alert_type = 'offline'").select(
        "id", F.lit(AS_OF).cast("timestamp_ntz").alias("resolved_at")
    )
    closed = resolve_alerts(episodes, closing)
    assert rows(closed.where("NOT is_resolved"), "alert_type") == [("high_temp",)]
    assert rows(closed.where("alert_type = 'low_battery'"), F.hour("resolved_at")) == [(5,)]


def test_device_alert_types(spark):
    alerts = device_alerts(found(spark, day("01:00:00", battery=5.0, signal_strength=-95)))
    assert rows(alerts, "alert_type", "severity", "is_resolved") == [("low_battery", "critical", False)]


def test_metric_alarm_missing_data(spark):
    frame = spark.createDataFrame(
        [("a", f"2024-01-01 00:{m:02d}:00", v) for m, v in ((0, 9.0), (5, 9.0), (15, 9.0), (20, 1.0))],
        "s string, t string, v double",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))

    def states(missing):
        alarm = metric_alarm(frame, ["s"], "t", "v", ">", 5.0, 2, missing=missing)
        return [r.state for r in alarm.orderBy("period_start").collect()]

    assert states("missing") == ["INSUFFICIENT_DATA", "ALARM", "INSUFFICIENT_DATA", "INSUFFICIENT_DATA", "OK"]
    assert states("breaching") == ["INSUFFICIENT_DATA", "ALARM", "ALARM", "ALARM", "OK"]
    assert states("not_breaching") == ["INSUFFICIENT_DATA", "ALARM", "OK", "OK", "OK"]


def test_throttle(spark):
    frame = silver_rows(spark, day("00:10:00"), day("03:59:59"), day("04:00:00"))
    assert rows(throttle(frame, ["region"]), "notified_at", "alert_count") == [
        (at("2024-01-10 00:10:00"), 2),
        (at("2024-01-10 04:00:00"), 1),
    ]
