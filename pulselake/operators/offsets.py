"""Replay guard on ranges of offsets: which records of a topic were processed already.

The log holds ranges of consecutive offsets instead of one row per offset, so it grows with the
gaps and not with the records, and no record is ever too late to be recognised. Ranges end at
blocks of ``BLOCK`` offsets: a block is what one task sorts at most, however large its topic
partition is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulselake.operators.incremental import OFFSET_KEY

BLOCK = 65_536

RANGES = (
    StructType()
    .add("kafka_topic", "string")
    .add("kafka_partition", "integer")
    .add("first_offset", "long")
    .add("last_offset", "long")
)

_BLOCK = ["kafka_topic", "kafka_partition", "_block"]


def _blocked(df: DataFrame, offset: str) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(offset) / F.lit(BLOCK)).cast("bigint"))


def offset_ranges(records: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """The log after ``records``: their offsets and the ranges of ``log``, as few ranges as there are.

    Records without topic, partition or offset have no place in a log. Offsets may repeat.
    """
    single = (
        records.select(*OFFSET_KEY)
        .dropna()
        .select(
            "kafka_topic",
            F.col("kafka_partition").cast("int"),
            F.col("kafka_offset").cast("bigint").alias("first_offset"),
            F.col("kafka_offset").cast("bigint").alias("last_offset"),
        )
        .distinct()
    )
    pieces = single if log is None else single.unionByName(log)
    earlier = (
        Window.partitionBy(*_BLOCK)
        .orderBy("first_offset", "last_offset")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    until_now = Window.partitionBy(*_BLOCK).orderBy("first_offset", "last_offset")
    begins = F.col("first_offset") > F.coalesce(F.max("last_offset").over(earlier) + 1, F.lit(-1))
    return (
        _blocked(pieces, "first_offset")
        .withColumn("_begins", begins.cast("int"))
        .withColumn("_range", F.sum("_begins").over(until_now.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*_BLOCK, "_range")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .select(*RANGES.fieldNames())
    )


def whole_ranges(log: DataFrame) -> DataFrame:
    """Ranges across blocks, for a report: one row for each gap of a topic partition and one more."""
    by_partition = Window.partitionBy("kafka_topic", "kafka_partition").orderBy("first_offset")
    begins = F.col("first_offset") > F.coalesce(F.lag("last_offset").over(by_partition) + 1, F.lit(-1))
    return (
        log.withColumn("_begins", begins.cast("int"))
        .withColumn("_range", F.sum("_begins").over(by_partition))
        .groupBy("kafka_topic", "kafka_partition", "_range")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .select(*RANGES.fieldNames())
    )


def unseen(records: DataFrame, log: DataFrame) -> DataFrame:
    """Records whose offset the log doesn't hold, one for each offset.

    Of records that share an offset any one stays: they are deliveries of the same record.
    Records without topic, partition or offset can't be recognised and all stay. Records and
    ranges of a block are sorted together and the last range's end is carried along, so a block
    with many gaps costs no more than one without.
    """
    known = F.col("kafka_topic").isNotNull() & F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull()
    placed = records.where(known)
    rows = _blocked(placed, "kafka_offset").select(
        *_BLOCK,
        F.col("kafka_offset").cast("bigint").alias("_at"),
        F.lit(None).cast("bigint").alias("_until"),
        F.struct(*records.columns).alias("_row"),
    )
    ranges = _blocked(log, "first_offset").select(
        *_BLOCK,
        F.col("first_offset").alias("_at"),
        F.col("last_offset").alias("_until"),
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"),
    )
    # A range stands before the record at its first offset.
    order = Window.partitionBy(*_BLOCK).orderBy("_at", F.col("_until").desc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fresh = (
        rows.unionByName(ranges)
        .withColumn("_reached", F.max(F.coalesce("_until", "_at")).over(before))
        .where(F.col("_until").isNull())
        .where(F.col("_reached").isNull() | (F.col("_at") > F.col("_reached")))
    )
    return fresh.select("_row.*").unionByName(records.where(~known))
