"""Notices of alert groups: the first alert waits for its group, repeats are held back.

Rules, for each group of alerts in order of time:

* The first alert opens a notice, sent ``wait`` later for all that came until then.
* A member of the group that was in none of its notices opens another, ``interval`` after the
  last one at the earliest.
* Any other alert is held back until ``repeat`` after the last notice sent, whichever clock hour
  that is; the next alert then opens a new notice and all members count as new again.

Each alert belongs to the last notice opened before it, so the notices' counts add up to all
alerts. Times are whole seconds. Members are few by nature, such as types or severities: a
notice carries those it knows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

# Times of the alert route.
WAIT = timedelta(seconds=30)
INTERVAL = timedelta(minutes=5)
REPEAT = timedelta(hours=4)

NOTICE = (
    StructType()
    .add("opened_at", "timestamp_ntz")
    .add("notified_at", "timestamp_ntz")
    .add("reason", "string")
    .add("known", ArrayType(StringType()))
    .add("alert_count", "long")
)


@dataclass(frozen=True)
class Route:
    """How alerts are grouped, what tells a group's members apart, and the three times."""

    group: tuple[str, ...]
    member: str | None = None
    wait: timedelta = WAIT
    interval: timedelta = INTERVAL
    repeat: timedelta = REPEAT
    time: str = "event_timestamp"

    def schema(self, alerts: DataFrame) -> StructType:
        """Schema of the notices of ``alerts``."""
        return StructType([*(alerts.schema[c] for c in self.group), *NOTICE.fields])


@dataclass
class Notice:
    group: tuple
    opened_at: pd.Timestamp
    notified_at: pd.Timestamp
    reason: str
    known: set = field(default_factory=set)
    alert_count: int = 0

    def row(self) -> tuple:
        return (*self.group, self.opened_at, self.notified_at, self.reason, sorted(self.known), self.alert_count)


def per_second(alerts: DataFrame, route: Route) -> DataFrame:
    """Alerts counted per group and second, with the members seen: all that the rules need.

    However many alerts a group has, it goes on with at most one row per second. Alerts without
    a time are left out; a null member is the empty one.
    """
    member = F.col(route.member).cast("string") if route.member else F.lit("")
    return (
        alerts.where(F.col(route.time).isNotNull())
        .groupBy(
            *route.group,
            F.date_trunc("second", F.col(route.time)).cast("timestamp_ntz").alias("at"),
        )
        .agg(F.collect_set(F.coalesce(member, F.lit(""))).alias("members"), F.count("*").alias("alerts"))
    )


def follow(rows: Iterable[tuple], width: int, route: Route) -> Iterator[Notice]:
    """The rules over rows in order of group and time; holds one notice at a time.

    A row has the ``width`` group values, time, members and count, then the opening time, time,
    reason and members of the notice its group starts from (None for a new group).
    """
    group, last = None, None
    for row in rows:
        at, members, alerts, opened, notified, reason, known = row[width:]
        if last is None or row[:width] != group:
            if last is not None:
                yield last
            group = row[:width]
            if opened is None:
                last = Notice(group, at, at + route.wait, "new")
            else:
                last = Notice(group, opened, notified, reason, set(known))
        if at > last.notified_at:
            if at >= last.notified_at + route.repeat:
                yield last
                last = Notice(group, at, at + route.wait, "new")
            elif not last.known.issuperset(members):
                yield last
                sent = max(at, last.notified_at + route.interval)
                last = Notice(group, at, sent, "change", set(last.known))
        if at <= last.notified_at:
            last.known.update(members)
        last.alert_count += alerts
    if last is not None:
        yield last


def _plain(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows with None for pandas' null marks, so that groups compare as they do in Spark."""
    for row in rows:
        yield tuple(None if pd.api.types.is_scalar(v) and pd.isna(v) else v for v in row)


def notices(seconds: DataFrame, route: Route, start: DataFrame | None = None) -> DataFrame:
    """Notices of alerts counted ``per_second``.

    ``start`` holds the last notice that stands for some of the groups; ``seconds`` then has the
    alerts of those groups from its opening on, and it comes first in the result, counted again.
    A task reads its groups in order of time and keeps one notice in memory, so a group of any
    length fits.
    """
    width = len(route.group)
    names = [f"_g{i}" for i in range(width)]
    keyed = seconds.select(
        *(F.col(c).alias(n) for c, n in zip(route.group, names)), "at", "members", "alerts"
    )
    kept = ["opened_at", "notified_at", "reason", "known"]
    if start is None:
        rows = keyed.select("*", *(F.lit(None).cast(NOTICE[c].dataType).alias(c) for c in kept))
    else:
        seeds = start.select(*(F.col(c).alias(f"_s{i}") for i, c in enumerate(route.group)), *kept)
        same = [F.col(n).eqNullSafe(F.col(f"_s{i}")) for i, n in enumerate(names)]
        rows = keyed.join(seeds, reduce(lambda a, b: a & b, same), "left").select(*keyed.columns, *kept)
    result = route.schema(seconds)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for frame in frames for row in _plain(frame.itertuples(index=False, name=None)))
        held = []
        for notice in follow(rows, width, route):
            held.append(notice.row())
            if len(held) == 10_000:
                yield pd.DataFrame(held, columns=result.fieldNames())
                held = []
        if held:
            yield pd.DataFrame(held, columns=result.fieldNames())

    ordered = rows.repartition(*names).sortWithinPartitions(*names, "at")
    return ordered.mapInPandas(run, result)


def repeat_suppressed(alerts: DataFrame, route: Route) -> DataFrame:
    """Notices of all alerts, in batch."""
    return notices(per_second(alerts, route), route)
