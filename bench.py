"""Wall time of the headline queries; prints one JSON line.

``build_lake`` derives the telemetry and builds Silver, quarantine and Gold. The Gold and
serving queries then run on those tables, the Bronze and Silver queries on the events table.
Every query is run to completion without collecting rows.
"""

from __future__ import annotations

import json
import os
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "c3_device_fields",
    "d2_quality_status",
    "e1_keep_latest",
    "e6_upsert",
    "f2_latest_per_device",
    "g_device_summary",
    "g16_health_score",
    "h1_previous_reading",
    "h11_all_anomalies",
    "i2_kpi_summary",
    "i3_device_status",
    "i4_temperature_trend",
    "i5_recent_anomalies",
    "i6_quarantine_breakdown",
    "i7_latest_positions",
    "j2_telemetry_measures",
    "k5_temperature_bins",
    "l3_alert_lifecycle",
    "l5_metric_alarm",
    "m2_refresh_registry",
    "o2_silver_stream",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from pulselake.plans import queries as registered
    from pulselake.session import prepare

    spark = prepare(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("pulselake-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # One pass over the input, so that start-up cost is not booked on the first query.
    drain(registered.telemetry(spark, SF_DIR))
    seconds: dict[str, float] = {}
    start = time.perf_counter()
    registered.lake_for(spark, SF_DIR)
    seconds["build_lake"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        drain(registered.QUERIES[name](spark, SF_DIR))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("/sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
