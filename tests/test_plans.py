"""Physical plans: what is pushed down, shuffled and kept out of Python."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulselake.operators.anomalies import anomalies
from pulselake.operators.dedup import READING_KEY, change_order, keep_latest
from pulselake.operators.summary import device_summary
from pulselake.operators.serving import latest_positions, latest_readings
from pulselake.plans import queries as registered
from pulselake.plans.queries import lake_for
from tests.conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    return lake_for(spark, SF)


def test_summary_is_one_hash_aggregation(spark, lake):
    text = plan(device_summary(lake.read_silver(spark)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "partial_count" in text


def test_dedup_limits_each_key_before_the_shuffle(spark, lake):
    silver = lake.read_silver(spark).withColumn("cdc_timestamp_ms", F.lit(1))
    text = plan(keep_latest(silver, READING_KEY, change_order()))
    partial = re.search(r"WindowGroupLimit.*Partial", text)
    assert partial and text.index("Exchange") < partial.start()


def test_anomalies_shuffle_readings_once(spark, lake):
    """One scan feeds all rules; its rows are shuffled by device and bucket only."""
    found = anomalies(lake.read_silver(spark), lake.read_summary(spark))
    text = plan(found)
    scans = [s for s in text.split("FileScan parquet")[1:] if "/silver" in s.split("\n")[0]]
    assert len(scans) == 2
    assert sum("battery" in s.split("ReadSchema")[1].split("\n")[0] for s in scans) == 1
    wide = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)]
    assert sum("_bucket" in x for x in wide) == 2


def test_latest_readings_hash_before_they_sort(spark, lake):
    text = plan(latest_readings(lake.read_silver(spark), ["region", "temperature"]))
    scan_side = text[text.rindex("Exchange") :]
    assert "partial_max_by(temperature" in scan_side and "Sort" not in scan_side


def test_positions_prune_dates_and_columns(spark, lake):
    text = plan(latest_positions(lake.read_silver(spark), "2024-01-20 12:00:00"))
    scan = text[text.index("FileScan parquet") :]
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "GreaterThanOrEqual(event_timestamp" in scan
    assert "humidity" not in scan


def test_no_query_leaves_the_jvm(spark):
    for name in ("g_device_summary", "h11_all_anomalies", "l3_alert_lifecycle", "e1_keep_latest"):
        text = plan(entry.queries()[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() == 382
    assert set(registered.ORACLES) == set(registered.QUERIES) <= set(entry.queries())
