"""Records of a stream written once each, however late they are delivered again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pulselake.operators.offsets import RANGES, offset_ranges, unseen
from pulselake.sinks.versions import batch_label, place, read_newest, read_version, versions, write_version
from pulselake.sources.tables import read_table
from pulselake.streaming.jobs import ONCE, Trigger, start_batches


def start_once(
    stream: DataFrame, target: str, log: str, checkpoint: str, trigger: Trigger = ONCE
) -> StreamingQuery:
    """Append the records whose offset ``log`` doesn't hold, one for each offset.

    A batch writes its new records into a folder of its own and then the log with their offsets.
    A crash in between, or after both, makes the batch write the same folder and log again. The
    log outlives the checkpoint: a stream that starts over writes nothing twice. One writer per
    log.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, own = place(spark, log, batch_label(spark, batch_id))
        seen = read_version(spark, log, before, RANGES)
        folder = f"{target}/load={own.number}"
        unseen(batch, seen).write.mode("overwrite").parquet(folder)
        # The offsets come from what was written, so the source is read once.
        written = spark.read.schema(batch.schema).parquet(folder)
        write_version(offset_ranges(written, seen), log, own)

    return start_batches(stream, handle, checkpoint, trigger)


def read_once(spark: SparkSession, target: str, log: str, schema: StructType) -> DataFrame:
    """Records of the loads that the log holds."""
    found = versions(spark, log)
    last = found[-1].number if found else -1
    loads = read_table(spark, target, StructType([*schema.fields]).add("load", "integer"))
    return loads.where(F.col("load") <= last).select(*schema.fieldNames())


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """Ranges of the offsets written so far."""
    return read_newest(spark, log, RANGES)
