"""Export of long-form measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pulselake.sinks.tables import write_partitioned


def ensure_table(df: DataFrame, path: str) -> None:
    """Create the measure table if it does not exist yet; existing data is left alone."""
    df.limit(0).write.mode("ignore").partitionBy("measure_name").parquet(path)


def write_measures(df: DataFrame, path: str) -> dict[str, int]:
    """Append measures below ``measure_name=``; rejected rows are counted and skipped.

    A row is rejected when it has no value or no time. Returns the counts of the run.
    """
    usable = F.col("measure_value").isNotNull() & F.col("time").isNotNull()
    seen = Observation("measures")
    counted = df.withColumn("_usable", usable).observe(
        seen,
        F.count_if(F.col("_usable")).alias("written"),
        F.count_if(~F.col("_usable")).alias("rejected"),
    )
    write_partitioned(
        counted.where("_usable").drop("_usable"), path, "measure_name", mode="append"
    )
    return {k: int(v) for k, v in seen.get.items()}
