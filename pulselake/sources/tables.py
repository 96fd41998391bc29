"""Table sources: relational snapshots and lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from pulselake.session import path_exists


def read_snapshot(
    spark: SparkSession,
    source: str,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Snapshot of a relational table.

    ``source`` is a JDBC URL, read in ``partitions`` parallel ranges of ``partition_column``, or
    a folder of Parquet files holding an export of the table.
    """
    if not source.startswith("jdbc:"):
        return spark.read.parquet(source if table is None else f"{source}/{table}.parquet")
    reader = spark.read.format("jdbc").option("url", source).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A lake table under a declared schema; a table not written yet reads as empty.

    Columns are matched by name, so files written before a column was added give NULL for it
    and a column no longer declared is not read.
    """
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def scan(df: DataFrame, columns: list[str], *conditions: Column) -> DataFrame:
    """Filter and projection; both reach the Parquet reader."""
    for condition in conditions:
        df = df.where(condition)
    return df.select(*columns)
