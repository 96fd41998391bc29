"""Repeat suppression with state, and the replay guard on ranges of offsets."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulselake.operators import offsets
from pulselake.operators.notices import INTERVAL, REPEAT, WAIT, Route, repeat_suppressed
from pulselake.operators.offsets import RANGES, offset_ranges, unseen, whole_ranges
from pulselake.sinks.versions import batch_label, place, read_newest, versions
from pulselake.streaming import jobs, replay
from pulselake.streaming.notices import notice_step

DAY = datetime(2024, 1, 10)
ALERTS = "id string, region string, kind string, event_timestamp timestamp_ntz, event_date date"


def alerts_frame(spark, rows):
    return spark.createDataFrame(
        [(str(i), region, kind, at, at.date() if at else DAY.date()) for i, (region, kind, at) in enumerate(rows)],
        ALERTS,
    )


def values(df):
    return sorted(
        ((r.region, r.opened_at, r.notified_at, r.reason, tuple(r.known), r.alert_count) for r in df.collect()),
        key=str,
    )


def at(text):
    return datetime.fromisoformat(f"2024-01-10 {text}")


def plain_notices(rows):
    """The rules read from the last notice to the next, over all alerts of a group each time."""
    found = []
    for region in {r[0] for r in rows}:
        mine = [(moment.replace(microsecond=0), kind or "") for g, kind, moment in rows if g == region and moment]
        sent = []
        while True:
            if not sent:
                later = mine
            else:
                _, last, _, known = sent[-1]
                later = [a for a in mine if a[0] > last and (a[0] >= last + REPEAT or a[1] not in known)]
            if not later:
                break
            opened = min(a[0] for a in later)
            if sent and opened < sent[-1][1] + REPEAT:
                when, reason, known = max(opened, sent[-1][1] + INTERVAL), "change", set(sent[-1][3])
            else:
                when, reason, known = opened + WAIT, "new", set()
            known |= {k for moment, k in mine if opened <= moment <= when}
            sent.append((opened, when, reason, known))
        for i, (opened, when, reason, known) in enumerate(sent):
            until = sent[i + 1][0] if i + 1 < len(sent) else datetime.max
            count = sum(opened <= moment < until for moment, _ in mine)
            found.append((region, opened, when, reason, tuple(sorted(known)), count))
    return sorted(found, key=str)


def random_alerts(seed, n=400):
    rng = random.Random(seed)
    hours = [0, 1, 3.9, 4, 4.1, 8, 20, 30]
    return [
        (
            rng.choice(["a", "a", "a", "b", None]),
            rng.choice(["x", "x", "x", "y", "z", None]),
            DAY + timedelta(hours=rng.choice(hours), seconds=rng.randrange(900), microseconds=rng.randrange(10**6)),
        )
        for _ in range(n)
    ]


def test_one_notice_across_a_clock_hour(spark):
    rows = [("a", "x", at("03:59:00")), ("a", "x", at("04:01:00"))]
    assert values(repeat_suppressed(alerts_frame(spark, rows), Route(("region",), "kind"))) == [
        ("a", at("03:59:00"), at("03:59:30"), "new", ("x",), 2)
    ]


def test_changes_and_repeats(spark):
    rows = [
        ("a", "x", at("00:00:00")),
        ("a", "y", at("00:00:10")),  # within the wait
        ("a", "x", at("00:01:00")),  # held back
        ("a", "z", at("00:02:00")),  # a change, five minutes after the last notice
        ("a", "w", at("00:04:00")),  # goes with it
        ("a", "x", at("04:05:29")),  # a second before the repeat
        ("a", "x", at("04:05:30")),
    ]
    assert values(repeat_suppressed(alerts_frame(spark, rows), Route(("region",), "kind"))) == [
        ("a", at("00:00:00"), at("00:00:30"), "new", ("x", "y"), 3),
        ("a", at("00:02:00"), at("00:05:30"), "change", ("w", "x", "y", "z"), 3),
        ("a", at("04:05:30"), at("04:06:00"), "new", ("x",), 1),
    ]


def test_no_alerts_and_no_times(spark):
    route = Route(("region",))
    assert repeat_suppressed(alerts_frame(spark, []), route).collect() == []
    assert repeat_suppressed(alerts_frame(spark, [("a", "x", None)]), route).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_as_plain_rules(spark, seed):
    rows = random_alerts(seed)
    got = values(repeat_suppressed(alerts_frame(spark, rows), Route(("region",), "kind")))
    assert got == plain_notices(rows)
    assert sum(v[-1] for v in got) == len(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_stream_as_batch_in_any_order(spark, tmp_path, seed):
    """Batches of random order, one of them delivered twice, one applied twice."""
    rows = random_alerts(seed, 160)
    random.Random(seed).shuffle(rows)
    route, frame = Route(("region",), "kind"), alerts_frame(spark, rows)
    path = str(tmp_path / "notices")
    step = notice_step(str(tmp_path / "alerts"), path, route, ["id"])
    parts = [frame.where(F.col("id").cast("int") % 3 == k) for k in range(3)]
    for number, part in enumerate([parts[0], parts[1], parts[1], parts[2]]):
        step(part, number)
    step(parts[2], 3)
    assert len(versions(spark, path)) == 2
    assert values(read_newest(spark, path, route.schema(frame))) == plain_notices(rows)


def test_late_alert_takes_back_a_notice(spark, tmp_path):
    route, path = Route(("region",)), str(tmp_path / "notices")
    step = notice_step(str(tmp_path / "alerts"), path, route, ["id"])
    frame = alerts_frame(spark, [("a", "x", at("05:00:00")), ("a", "x", at("02:00:00")), ("b", "x", at("05:00:00"))])
    step(frame.where("id <> '1'"), 0)
    assert [v[1] for v in values(read_newest(spark, path, route.schema(frame)))] == [at("05:00:00")] * 2
    step(frame.where("id = '1'"), 1)
    assert values(read_newest(spark, path, route.schema(frame))) == [
        ("a", at("02:00:00"), at("02:00:30"), "new", ("",), 2),
        ("b", at("05:00:00"), at("05:00:30"), "new", ("",), 1),
    ]


RECORDS = "kafka_topic string, kafka_partition int, kafka_offset bigint, body string"


def records_of(spark, numbers, partition=0):
    return spark.createDataFrame([("t", partition, n, f"r{n}") for n in numbers], RECORDS)


def spans(df):
    return sorted((r.kafka_partition, r.first_offset, r.last_offset) for r in df.collect())


def test_ranges_grow_with_gaps_only(spark):
    log = offset_ranges(records_of(spark, [*range(500), *range(600, 5000), *range(600, 700)]))
    assert spans(log) == [(0, 0, 499), (0, 600, 4999)]
    log = offset_ranges(records_of(spark, range(500, 600)), log)
    assert spans(log) == [(0, 0, 4999)]


def test_ranges_and_unseen_as_sets(spark, monkeypatch):
    """Small blocks, so that ranges end at many of their borders."""
    monkeypatch.setattr(offsets, "BLOCK", 16)
    rng = random.Random(5)
    known = {(p, rng.randrange(120)) for p in (0, 1) for _ in range(70)}
    given = [(p, rng.randrange(140)) for p in (0, 1, 2) for _ in range(90)]
    first = spark.createDataFrame([("t", p, n, "") for p, n in known], RECORDS)
    batch = spark.createDataFrame([("t", p, n, "") for p, n in given], RECORDS)
    log = offset_ranges(first)
    fresh = [(r.kafka_partition, r.kafka_offset) for r in unseen(batch, log).collect()]
    assert sorted(fresh) == sorted(set(given) - known)
    after = offset_ranges(unseen(batch, log), log)
    covered = [(p, n) for p, a, b in spans(after) for n in range(a, b + 1)]
    assert sorted(covered) == sorted(known | set(given))
    assert all(a // 16 == b // 16 for _, a, b in spans(after))
    whole = spans(whole_ranges(after))
    every = known | set(given)
    assert len(whole) == sum((p, n - 1) not in every for p, n in every)
    assert spans(whole_ranges(offset_ranges(batch.limit(0), log))) == spans(whole_ranges(log))


def test_records_without_position_stay(spark):
    odd = spark.createDataFrame([(None, 0, 1, "a"), ("t", None, 1, "b"), ("t", 0, None, "c"), ("t", 0, None, "c")], RECORDS)
    assert offset_ranges(odd).collect() == []
    assert sorted(r.body for r in unseen(odd, spark.createDataFrame([], RANGES)).collect()) == ["a", "b", "c", "c"]


def test_once_after_any_delay_and_restart(spark, tmp_path):
    """Everything is delivered again later, then by a stream with a new checkpoint."""
    source, target, log = (str(tmp_path / n) for n in ("source", "target", "log"))
    deliveries = [range(0, 50), range(40, 90), range(0, 90), range(95, 100)]
    for i, numbers in enumerate(deliveries):
        records_of(spark, numbers).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", 1).parquet(source)
        checkpoint = str(tmp_path / ("first" if i < 3 else "second"))
        replay.start_once(stream, target, log, checkpoint, jobs.ONCE).awaitTermination()
    schema = records_of(spark, [0]).schema
    got = sorted(r.kafka_offset for r in replay.read_once(spark, target, log, schema).collect())
    assert got == [*range(90), *range(95, 100)]
    assert spans(replay.read_log(spark, log)) == [(0, 0, 89), (0, 95, 99)]


def test_batch_again_starts_from_the_version_before(spark, tmp_path):
    path = str(tmp_path / "log")
    first, second = batch_label(spark, 0), batch_label(spark, 1)
    for label in (first, second):
        before, own = place(spark, path, label)
        offset_ranges(records_of(spark, [own.number])).write.parquet(f"{path}/{own.folder}")
    before, own = place(spark, path, second)
    assert (before.label, before.number, own.number) == (first, 0, 1)
    assert place(spark, path, "other")[1].number == 2
