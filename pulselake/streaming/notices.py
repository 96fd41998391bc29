"""Notices of a stream of alerts, right for any order in which the alerts arrive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.operators.notices import Route, notices, per_second
from pulselake.operators.upsert import upsert
from pulselake.session import release, scratch_path
from pulselake.sinks.versions import batch_label, place, read_version, write_version
from pulselake.sources.tables import read_table
from pulselake.streaming.jobs import BatchHook


def notice_step(alerts_path: str, path: str, route: Route, keys: list[str]) -> BatchHook:
    """Step on alert batches: keeps the alerts by ``keys`` and the notices of their groups.

    A batch's groups go back to their last notice before its earliest alert and follow the rules
    from there over the kept alerts, so a late alert changes the notices after it and nothing
    else, and the result is that of a batch run over all alerts. ``event_date`` is the alerts'
    partition; an alert's group never changes. The notices are few by their rules and are kept
    as whole versions, so a repeated batch writes the same version again.
    """
    group = list(route.group)

    def matched(left: str, right: str):
        equal = (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in group)
        return reduce(lambda a, b: a & b, equal)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = route.schema(batch)
        before, own = place(spark, path, batch_label(spark, batch_id))
        upsert(batch.dropDuplicates(keys), alerts_path, keys, "event_date")
        old = read_version(spark, path, before, schema)
        second = F.date_trunc("second", F.col(route.time)).cast("timestamp_ntz")
        earliest = batch.where(F.col(route.time).isNotNull()).groupBy(*group).agg(F.min(second).alias("since"))
        held = scratch_path(spark, "touched-groups")
        earliest.write.parquet(held)
        touched = spark.read.schema(earliest.schema).parquet(held)

        aged = old.alias("n").join(touched.alias("t"), matched("n", "t"), "left")
        rest = aged.where(F.col("t.since").isNull() | (F.col("n.notified_at") < F.col("t.since")))
        newest = Window.partitionBy(*(F.col(f"n.{c}") for c in group)).orderBy(F.desc("n.notified_at"))
        ranked = rest.withColumn("_rank", F.row_number().over(newest))
        starting = F.col("t.since").isNotNull() & (F.col("_rank") == 1)
        start = ranked.where(starting).select("n.*")
        untouched = ranked.where(~starting).select("n.*")

        # A group without a start is followed from its first alert, which an old notice may hold.
        opened = aged.where("t.since IS NOT NULL").groupBy(*(F.col(f"n.{c}") for c in group)).agg(
            F.min("n.opened_at").alias("first_opened")
        )
        bounds = (
            touched.alias("t")
            .join(start.alias("s"), matched("t", "s"), "left")
            .join(opened.alias("o"), matched("t", "o"), "left")
            .select(
                *(F.col(f"t.{c}") for c in group),
                F.coalesce("s.opened_at", F.least("t.since", "o.first_opened")).alias("bound"),
            )
        )
        floor = bounds.agg(F.min("bound")).first()[0]
        if floor is not None:
            alerts = read_table(spark, alerts_path, batch.schema)
            recent = alerts.where(F.col("event_date") >= F.lit(floor.date()))
            # Groups the batch doesn't touch, and what lies before the start, go before the count.
            needed = recent.alias("a").join(
                bounds.alias("b"), matched("a", "b") & (F.col(f"a.{route.time}") >= F.col("b.bound")), "left_semi"
            )
            followed = notices(per_second(needed, route), route, start)
            write_version(untouched.unionByName(followed), path, own)
        release(spark, held)

    return step
