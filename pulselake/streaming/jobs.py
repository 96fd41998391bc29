"""Streaming jobs of the medallion flow.

Each ``start_*`` returns a running ``StreamingQuery``. ``trigger`` is passed on to
``DataStreamWriter.trigger``: ``{"availableNow": True}`` for a scheduled incremental run,
``{"processingTime": "5 minutes"}`` for a continuous one. Append jobs use the exactly-once file
sink; jobs that replace rows use ``foreachBatch`` with an upsert guarded by the batch id.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from pulselake.config import Config
from pulselake.functions.quality import VALID, quality_status
from pulselake.functions.timeutil import minutes_crossed
from pulselake.operators.alerts import alert_filter
from pulselake.operators.anomalies import (
    DEVICE,
    LAGGED,
    READING_COLUMNS,
    device_days,
    fire,
    rapid_change_rule,
    reading_rules,
    rolling_stats,
    spike_rule,
    verdicts,
)
from pulselake.operators.bronze import bronze
from pulselake.operators.silver import silver_columns
from pulselake.operators.summary import GRAIN
from pulselake.operators.timeline import with_neighbour
from pulselake.operators.upsert import upsert
from pulselake.plans.medallion import Lake, load_silver
from pulselake.schemas import ANOMALIES, RAW
from pulselake.session import stage
from pulselake.sinks.archive import RECORDS_PER_FILE, dead_letter_path, split_hours
from pulselake.sinks.dead_letter import split_dead_letters
from pulselake.sinks.tables import write_partitioned
from pulselake.sources.archive import PARTS
from pulselake.sources.tables import read_table
from pulselake.sources.topics import read_envelope, to_raw
from pulselake.streaming.aggregates import device_day

Trigger = dict
ONCE: Trigger = {"availableNow": True}
EVERY_FIVE_MINUTES: Trigger = {"processingTime": "5 minutes"}
# Fixed value: longest time between flushes of the raw landing.
LANDING_TRIGGER: Trigger = {"processingTime": "60 seconds"}

BatchHook = Callable[[DataFrame, int], None]


def start_append(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    trigger: Trigger = ONCE,
    partition_by: list[str] | None = None,
    file_format: str = "parquet",
    **options,
) -> StreamingQuery:
    """Append a stream to files, each row exactly once."""
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    for key, value in options.items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**trigger).start()


def start_batches(
    stream: DataFrame,
    handle: BatchHook,
    checkpoint: str,
    trigger: Trigger = ONCE,
    mode: str = "append",
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .trigger(**trigger)
        .start()
    )


def start_landing(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    trigger: Trigger = LANDING_TRIGGER,
    **source_options,
) -> StreamingQuery:
    """Topic records to the raw landing table; as fast as they come unless ``max_records`` is given."""
    envelope = read_envelope(spark, source, streaming=True, **source_options)
    return start_append(to_raw(envelope), target, checkpoint, trigger)


def read_raw_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_bronze(
    spark: SparkSession,
    raw_path: str,
    target: str,
    checkpoint: str,
    trigger: Trigger = ONCE,
    max_files: int | None = None,
) -> StreamingQuery:
    """Raw landing to typed Bronze readings."""
    return start_append(
        bronze(read_raw_stream(spark, raw_path, max_files)), target, checkpoint, trigger
    )


def start_silver(
    spark: SparkSession,
    raw_path: str,
    lake: Lake,
    checkpoint: str,
    trigger: Trigger = ONCE,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
    max_files: int | None = None,
    then: list[BatchHook] | None = None,
) -> StreamingQuery:
    """Raw landing to Silver and quarantine by upsert; ``then`` runs on the valid readings."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        steps = [lambda valid, step=step: step(valid, batch_id) for step in then or []]
        load_silver(batch, lake, cfg, as_of, steps)

    return start_batches(
        bronze(read_raw_stream(spark, raw_path, max_files)), handle, checkpoint, trigger
    )


def start_upserts(
    stream: DataFrame,
    target: str,
    keys: list[str],
    partition_col: str,
    checkpoint: str,
    trigger: Trigger = ONCE,
    mode: str = "append",
    sort_by: list[str] | None = None,
) -> StreamingQuery:
    """Upsert each batch by key; a repeated batch leaves the table as it was."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, target, keys, partition_col, sort_by=sort_by)

    return start_batches(stream, handle, checkpoint, trigger, mode)


def start_summary(
    readings: DataFrame, target: str, checkpoint: str, trigger: Trigger = ONCE, lateness: str = "1 day"
) -> StreamingQuery:
    """Running device-day summary of deduplicated readings; changed rows are upserted."""
    return start_upserts(
        device_day(readings, lateness),
        target,
        GRAIN,
        "event_date",
        checkpoint,
        trigger,
        "update",
        ["region"],
    )


def valid_readings(
    readings: DataFrame, cfg: Config = Config(), as_of: datetime | str | None = None
) -> DataFrame:
    """Silver columns of valid Bronze readings, without deduplication (stateless)."""
    checked = readings.withColumn("dq_status", quality_status(cfg, as_of))
    return silver_columns(checked.where(F.col("dq_status") == VALID), cfg)


def start_alerts(
    readings: DataFrame,
    target: str,
    checkpoint: str,
    trigger: Trigger = ONCE,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
) -> StreamingQuery:
    """Anomalies that need a single reading, appended as readings arrive."""
    found = fire(readings, reading_rules(cfg), as_of)
    return start_append(found, target, checkpoint, trigger, ["event_date"])


def start_critical_readings(
    readings: DataFrame, target: str, checkpoint: str, trigger: Trigger = ONCE, cfg: Config = Config()
) -> StreamingQuery:
    """Continuous alert filter: readings that are too hot or nearly out of battery."""
    return start_append(alert_filter(readings, cfg), target, checkpoint, trigger)


RAISED = StructType([*ANOMALIES.fields, StructField("retracted", BooleanType())])


def nearby_dates(batch: DataFrame) -> list[date]:
    """Dates of a batch and their neighbours; as many values as dates, so safe to collect."""
    day = F.col("event_date")
    around = F.explode(F.array(F.date_sub(day, 1), day, F.date_add(day, 1))).alias("d")
    return [r.d for r in batch.select("event_date").distinct().select(around).distinct().collect()]


def rapid_changes_around(
    batch: DataFrame,
    silver: DataFrame,
    dates: list[date],
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
) -> DataFrame:
    """The rapid-change verdict on the readings a batch touched, and on those right after.

    A change spans at most ``rapid_change_minutes``, so the previous reading that matters lies
    in the same hour or the one before. Only those device-hours of Silver take part (staged, as
    the lag reads them in several branches), whatever the order in which readings arrive: a late
    reading also re-evaluates its successor. ``retracted`` is true where the rule does not fire.
    """
    hours = batch.select(
        "device_id", F.date_trunc("hour", "event_timestamp").alias("_touched")
    ).distinct()

    def around(offsets: list[int]) -> DataFrame:
        shifted = F.array(*(F.col("_touched") + F.make_dt_interval(hours=F.lit(h)) for h in offsets))
        return hours.select("device_id", F.explode(shifted).alias("_hour")).distinct()

    nearby = stage(
        silver.where(F.col("event_date").isin(dates))
        .select(*READING_COLUMNS)
        .withColumn("_hour", F.date_trunc("hour", "event_timestamp"))
        .join(around([-1, 0, 1]), ["device_id", "_hour"], "left_semi"),
        "nearby",
    )
    lagged = with_neighbour(nearby, DEVICE, "event_timestamp", LAGGED, cfg=cfg).withColumn(
        "minutes_since_last",
        minutes_crossed(F.col("prev_event_timestamp"), F.col("event_timestamp")),
    )
    judged = lagged.join(around([0, 1]), ["device_id", "_hour"], "left_semi")
    return verdicts(judged, rapid_change_rule(cfg), as_of)


def read_raised(spark: SparkSession, target: str) -> DataFrame:
    """Alerts that still stand."""
    return read_table(spark, target, RAISED).where("NOT retracted").drop("retracted")


def rapid_change_step(
    lake: Lake, target: str, cfg: Config = Config(), as_of: datetime | str | None = None
) -> BatchHook:
    """Step after ``start_silver``: rapid changes across batches, upserted by anomaly id.

    An alert raised earlier that no longer holds, because a reading arrived late or was
    corrected, is marked as retracted; ``read_raised`` leaves it out.
    """

    def step(valid: DataFrame, batch_id: int) -> None:
        spark = valid.sparkSession
        dates = nearby_dates(valid)
        judged = rapid_changes_around(valid, lake.read_silver(spark), dates, cfg, as_of)
        raised = read_table(spark, target, RAISED).where(F.col("event_date").isin(dates))
        known = raised.select("anomaly_id", F.lit(True).alias("_known"))
        changed = judged.join(known, "anomaly_id", "left").where("NOT retracted OR _known")
        upsert(
            changed.select(*RAISED.fieldNames()),
            target,
            ["anomaly_id"],
            "event_date",
        )

    return step


def spike_step(
    lake: Lake, target: str, cfg: Config = Config(), as_of: datetime | str | None = None
) -> BatchHook:
    """Step after ``start_silver``: temperature spikes against the newest rolling statistics.

    The summary table is read again for each batch, so a rebuilt summary takes effect at once.
    """

    def step(valid: DataFrame, batch_id: int) -> None:
        spark = valid.sparkSession
        stats = rolling_stats(device_days(lake.read_summary(spark)), cfg)
        joined = valid.join(stats, ["device_id", "event_date"], "left")
        found = fire(joined, [spike_rule(cfg)], as_of)
        upsert(found, target, ["anomaly_id"], "event_date")

    return step


def gold_step(
    lake: Lake,
    target: str,
    aggregate: Callable[[DataFrame], DataFrame],
    sort_by: list[str] | None = None,
) -> BatchHook:
    """Step after ``start_silver``: the dates a batch touches are aggregated again from Silver.

    ``aggregate`` gives rows with ``event_date`` that need readings of that date only. No
    watermark: a reading counts however late it comes, and a corrected one in its new group only.
    """

    def step(valid: DataFrame, batch_id: int) -> None:
        silver = lake.read_silver(valid.sparkSession)
        dates = valid.select("event_date").distinct()
        # Pruned at run time: only dates that the batch touches are opened.
        touched = silver.join(dates, "event_date", "left_semi").select(*silver.columns)
        write_partitioned(aggregate(touched), target, "event_date", sort_by, only_touched=True)

    return step


def start_archive(
    events: DataFrame,
    target: str,
    checkpoint: str,
    trigger: Trigger = ONCE,
    dead_letters: str | None = None,
    as_of: datetime | str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Hourly JSON archive of published events, and dead letters of those without a readable time."""
    placed, unplaced = split_hours(events, as_of=as_of)
    archive = start_append(
        placed,
        target,
        f"{checkpoint}/archive",
        trigger,
        PARTS,
        "json",
        maxRecordsPerFile=RECORDS_PER_FILE,
        compression="snappy",
    )
    letters = start_append(
        unplaced, dead_letters or dead_letter_path(target), f"{checkpoint}/dead-letters", trigger
    )
    return archive, letters


def start_dead_letters(
    envelope: DataFrame,
    target: str,
    dead_letter_target: str,
    checkpoint: str,
    trigger: Trigger = ONCE,
    cfg: Config = Config(),
    as_of: datetime | str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Valid records to ``target``, all others with reason and time to the dead letters.

    Two exactly-once file sinks over the same source; a bad record never stops the job.
    """
    valid, rejected = split_dead_letters(envelope, cfg, as_of)
    return (
        start_append(valid, target, f"{checkpoint}/valid", trigger),
        start_append(rejected, dead_letter_target, f"{checkpoint}/rejected", trigger),
    )
