import os

import pytest
from pyspark.sql import functions as F

from pulselake.operators import upsert as upsert_module
from pulselake.operators.incremental import (
    incremental,
    insert_absent,
    processing_log,
    skip_processed,
)
from pulselake.operators.upsert import merge, upsert
from pulselake.session import require_local
from pulselake.streaming import jobs
from pulselake.plans.medallion import Lake, load_silver, rebuild_gold, run, silver_violations
from pulselake.sinks.tables import schema_changes
from pulselake.sources.derived import raw_landing, telemetry
from pulselake.sources.tables import read_table
from tests.conftest import SF
from tests.frames import readings, rows, same

AS_OF = "2024-02-01 00:00:00"
SCHEMA = "k string, day date, version bigint, v string"


def frame(spark, *data):
    return spark.createDataFrame(
        [(k, d, n, v) for k, d, n, v in data], "k string, d string, version bigint, v string"
    ).select("k", F.col("d").cast("date").alias("day"), "version", "v")


def table(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path), "k", "version", "v")


def files(path):
    return {
        os.path.join(folder, f)
        for folder, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_upsert_replaces_inserts_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, ("a", "2024-01-01", 1, "x"), ("b", "2024-01-02", 1, "x"))
    upsert(first, path, ["k", "day"], "day", ["version"])
    untouched = files(f"{path}/day=2024-01-01")
    batch = frame(spark, ("b", "2024-01-02", 2, "y"), ("c", "2024-01-03", 1, "z"))
    for _ in range(2):
        upsert(batch, path, ["k", "day"], "day", ["version"])
        assert table(spark, path) == [("a", 1, "x"), ("b", 2, "y"), ("c", 1, "z")]
    assert files(f"{path}/day=2024-01-01") == untouched


def test_older_version_does_not_win(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, ("a", "2024-01-01", 5, "new")), path, ["k", "day"], "day", ["version"])
    late = frame(
        spark, ("a", "2024-01-01", 3, "old"), ("a", "2024-01-01", 4, "old"), ("b", "2024-01-01", 1, "b")
    )
    upsert(late, path, ["k", "day"], "day", ["version"])
    assert table(spark, path) == [("a", 5, "new"), ("b", 1, "b")]
    blind = frame(spark, ("a", "2024-01-01", 3, "blind"))
    upsert(blind, path, ["k", "day"], "day")
    assert table(spark, path) == [("a", 3, "blind"), ("b", 1, "b")]


def test_null_keys_match(spark):
    old = frame(spark, (None, "2024-01-01", 1, "old"), ("a", "2024-01-01", 1, "a"))
    new = frame(spark, (None, "2024-01-01", 2, "new"))
    assert rows(merge(old, new, ["k", "day"], ["version"]), "k", "v") == [(None, "new"), ("a", "a")]
    assert rows(merge(old, new, ["k", "day"]), "k", "v") == [(None, "new"), ("a", "a")]


def test_columns_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(frame(spark, ("a", "2024-01-01", 1, "x")), path, ["k", "day"], "day")
    wider = frame(spark, ("b", "2024-01-01", 1, "y")).withColumn("extra", F.lit(7)).drop("version")
    upsert(wider, path, ["k", "day"], "day")
    got = read_table(spark, path, wider.schema)
    assert rows(got, "k", "v", "extra") == [("a", "x", None), ("b", "y", 7)]
    changes = schema_changes(frame(spark, ("a", "2024-01-01", 1, "x")).schema, wider.schema)
    assert changes == {"added": ["extra"], "removed": ["version"]}


def test_crash_during_the_copy_is_finished_by_any_later_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(frame(spark, ("a", "2024-01-01", 1, "x")), path, ["k", "day"], "day")
    real = upsert_module.write_partitioned

    def crash(*args, **kwargs):
        # The old partition is gone already, the new one not there yet.
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)
        for old in (tmp_path / "t").glob("day=*/*"):
            old.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(upsert_module, "write_partitioned", crash)
    with pytest.raises(RuntimeError):
        upsert(frame(spark, ("b", "2024-01-01", 1, "y")), path, ["k", "day"], "day")
    monkeypatch.setattr(upsert_module, "write_partitioned", real)
    upsert(frame(spark, ("c", "2024-01-01", 1, "z")), path, ["k", "day"], "day")
    assert table(spark, path) == [("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z")]


def test_crash_while_merging_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(frame(spark, ("a", "2024-01-01", 1, "x")), path, ["k", "day"], "day")
    real = upsert_module.merge
    monkeypatch.setattr(upsert_module, "merge", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        upsert(frame(spark, ("b", "2024-01-01", 1, "y")), path, ["k", "day"], "day")
    assert table(spark, path) == [("a", 1, "x")]
    monkeypatch.setattr(upsert_module, "merge", real)
    upsert(frame(spark, ("b", "2024-01-01", 1, "y")), path, ["k", "day"], "day")
    assert table(spark, path) == [("a", 1, "x"), ("b", 1, "y")]


def test_tables_with_similar_paths_stay_apart(spark, tmp_path):
    one, two = str(tmp_path / "x" / "y"), str(tmp_path / "x_y")
    for path, name in ((one, "one"), (two, "two")):
        upsert(frame(spark, (name, "2024-01-01", 1, "old")), path, ["k", "day"], "day")
        upsert(frame(spark, (name, "2024-01-01", 2, "new")), path, ["k", "day"], "day")
    assert table(spark, one) == [("one", 2, "new")]
    assert table(spark, two) == [("two", 2, "new")]


def test_stream_and_batch_loads_may_alternate(spark, tmp_path):
    """The same batch number from a stream with a new checkpoint is another batch."""
    path, base = str(tmp_path / "t"), tmp_path
    for n, key in enumerate("bcd"):
        if key == "c":
            upsert(frame(spark, (key, "2024-01-01", 1, key)), path, ["k", "day"], "day")
            continue
        source = str(base / f"in{n}")
        frame(spark, (key, "2024-01-01", 1, key)).write.parquet(source)
        jobs.start_upserts(
            spark.readStream.schema(SCHEMA).parquet(source), path, ["k", "day"], "day", str(base / f"check{n}")
        ).awaitTermination()
    assert table(spark, path) == [("b", 1, "b"), ("c", 1, "c"), ("d", 1, "d")]


def test_nothing_stays_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pulselake.session.shared_dir", lambda s: str(tmp_path / "shared"))
    lake = Lake(str(tmp_path / "lake"))
    run(raw_landing(telemetry(spark, SF)), lake, as_of=AS_OF)
    run(raw_landing(telemetry(spark, SF)), lake, as_of=AS_OF, incremental=False)
    assert [p for p in (tmp_path / "shared").rglob("*") if "anomal" not in str(p) and p.suffix == ".parquet"] == []
    assert list((tmp_path / "lake").rglob("_redo")) == []


def test_run_after_a_failed_quarantine_write_loses_nothing(spark, tmp_path, monkeypatch):
    from pulselake.plans import medallion

    lake, whole = Lake(str(tmp_path / "lake")), Lake(str(tmp_path / "whole"))
    real = medallion.upsert

    def fail(batch, path, *args, **kwargs):
        if path == lake.quarantine:
            raise RuntimeError("lost")
        real(batch, path, *args, **kwargs)

    raw = raw_landing(telemetry(spark, SF))
    monkeypatch.setattr(medallion, "upsert", fail)
    with pytest.raises(RuntimeError):
        run(raw, lake, as_of=AS_OF)
    monkeypatch.setattr(medallion, "upsert", real)
    run(raw, lake, as_of=AS_OF)
    run(raw, whole, as_of=AS_OF)
    assert lake.read_quarantine(spark).count() == whole.read_quarantine(spark).count() > 0
    assert lake.read_silver(spark).count() == whole.read_silver(spark).count()


def test_no_local_folder_on_a_cluster():
    for master in ("local", "local[8]", "local[*]"):
        require_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"):
        with pytest.raises(ValueError):
            require_local(master)


def test_incremental_replay_and_insert_absent(spark):
    batch = readings(
        spark,
        {"kafka_offset": 1, "ingested_at": "2024-01-01 00:00:00"},
        {"kafka_offset": 2, "ingested_at": "2024-01-02 00:00:00"},
    )
    loaded = batch.where("kafka_offset = 1")
    assert rows(incremental(batch, loaded, "ingested_at"), "kafka_offset") == [(2,)]
    assert rows(incremental(batch, None, "ingested_at"), "kafka_offset") == [(1,), (2,)]
    assert rows(incremental(batch, loaded.limit(0), "ingested_at"), "kafka_offset") == [(1,), (2,)]

    log = processing_log(loaded, AS_OF)
    assert rows(log, "kafka_offset", "event_count") == [(1, 1)]
    assert rows(skip_processed(batch.unionByName(batch), log), "kafka_offset") == [(2,)]

    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "k string, v int")
    old = spark.createDataFrame([("a", 9)], "k string, v int")
    assert rows(insert_absent(new, old, ["k"]), "k", "v") == [("b", 1)]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Lake loaded from raw variants in two scheduled runs."""
    built = Lake(str(tmp_path_factory.mktemp("lake")))
    raw = raw_landing(telemetry(spark, SF))
    early = raw.where("ingested_at <= TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    run(early, built, as_of=AS_OF)
    run(raw, built, as_of=AS_OF)
    return built


def test_scheduled_runs_equal_one_load(spark, lake, tmp_path):
    whole = Lake(str(tmp_path / "lake"))
    run(raw_landing(telemetry(spark, SF)), whole, as_of=AS_OF, incremental=False)
    assert lake.read_silver(spark).count() == 896
    assert same(lake.read_silver(spark), whole.read_silver(spark))
    # Deduplication is per run, so two runs may keep two rejected versions of one reading.
    kept = ["device_id", "event_timestamp", "kafka_offset", "rejection_reason"]
    in_runs, at_once = (x.read_quarantine(spark).select(kept) for x in (lake, whole))
    assert at_once.exceptAll(in_runs).isEmpty()
    assert same(lake.read_summary(spark), whole.read_summary(spark))
    assert same(lake.read_anomalies(spark), whole.read_anomalies(spark))


def test_quarantine_keeps_the_payload(spark, lake):
    payload = F.try_variant_get("original_payload", "$.model", "string")
    assert lake.read_quarantine(spark).where(payload.isNull()).isEmpty()


def test_rerun_without_new_rows_changes_nothing(spark, lake):
    before = lake.read_silver(spark).collect()
    run(raw_landing(telemetry(spark, SF)), lake, as_of=AS_OF)
    assert sorted(map(str, lake.read_silver(spark).collect())) == sorted(map(str, before))


def test_silver_gates(spark, lake):
    broken = {k: v.count() for k, v in silver_violations(lake.read_silver(spark), AS_OF).items()}
    assert broken == {"coordinates": 0, "not_null": 7, "times": 0, "unique_key": 0}


def test_all_rows_rejected(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    load_silver(readings(spark, {"temperature": 99.0}), lake, as_of=AS_OF)
    assert lake.read_silver(spark).isEmpty()
    assert lake.read_quarantine(spark).count() == 1
    rebuild_gold(spark, lake, as_of=AS_OF)
    assert lake.read_anomalies(spark).isEmpty()
