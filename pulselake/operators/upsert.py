"""Keyed upsert into a partitioned Parquet table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.operators.dedup import keep_latest
from pulselake.operators.incremental import anti_join, same_key
from pulselake.session import path_exists, release, scratch_path
from pulselake.sinks.tables import write_partitioned
from pulselake.sources.tables import read_table


def newest_per_key(batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    return keep_latest(batch, keys, [F.desc(c) for c in order_by])


def merge(
    existing: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """State after the upsert: matching keys are replaced by the batch row, others inserted.

    The batch holds one row per key (``newest_per_key``). With ``order_by`` the row with the
    higher order values wins, whichever side it is on, and ties go to the batch; without it the
    batch always wins. Keys are compared null-safe. Existing rows are only filtered: when the
    batch is small the adaptive planner broadcasts its keys and existing rows are not shuffled.
    """
    if order_by is None:
        kept = anti_join(existing, batch, keys)
        return kept.unionByName(batch, allowMissingColumns=True).select(*batch.columns)

    matched = same_key("e", "b", keys)

    def order(side: str) -> Column:
        return F.struct(*(F.col(f"{side}.{c}") for c in order_by))

    new = batch.select(*keys, *order_by).alias("b")
    kept = existing.alias("e").join(new, matched & (order("b") >= order("e")), "left_anti")
    outdated = (
        existing.select(*keys, *order_by)
        .alias("e")
        .join(new, matched & (order("e") > order("b")), "left_semi")
    )
    incoming = anti_join(batch, outdated, keys)
    return kept.unionByName(incoming, allowMissingColumns=True).select(*batch.columns)


def _redo(path: str) -> str:
    """Folder inside the table, hidden from its readers, with partitions about to replace others."""
    return f"{path.rstrip('/')}/_redo/rows"


def recover(spark: SparkSession, path: str, partition_col: str, sort_by: list[str] | None = None) -> None:
    """Finish a replacement of partitions that was interrupted.

    The merged partitions are complete once their ``_SUCCESS`` exists. Copying them over the
    table repeats what a crash left half done; without it they were never applied and go.
    """
    redo = _redo(path)
    if path_exists(spark, f"{redo}/_SUCCESS"):
        write_partitioned(spark.read.parquet(redo), path, partition_col, sort_by, only_touched=True)
    release(spark, redo.removesuffix("/rows"))


def replace_partitions(
    rows: DataFrame, path: str, partition_col: str, sort_by: list[str] | None, dates: DataFrame
) -> None:
    """Put ``rows`` in place of the partitions named by ``dates``; a crash is finished by ``recover``.

    ``rows`` may be read from these very partitions. A partition that gets no rows goes; the
    driver learns the names of such partitions only.
    """
    spark = rows.sparkSession
    recover(spark, path, partition_col, sort_by)
    rows.write.mode("overwrite").parquet(_redo(path))
    left = spark.read.schema(rows.schema).parquet(_redo(path)).select(partition_col).distinct()
    emptied = [r[0] for r in dates.select(partition_col).distinct().join(left, partition_col, "left_anti").collect()]
    recover(spark, path, partition_col, sort_by)
    for value in emptied:
        release(spark, f"{path.rstrip('/')}/{partition_col}={value}")


def upsert(
    batch: DataFrame,
    path: str,
    keys: list[str],
    partition_col: str,
    order_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    staged: bool = False,
) -> None:
    """Upsert ``batch`` into the table at ``path``; only touched partitions are rewritten.

    ``partition_col`` must be non-null and derived from the key, so a key never changes
    partition. The table takes the columns of the batch: new columns are NULL in older rows,
    vanished columns are no longer read.

    One writer per table. The batch is reduced to one row per key and written to the shared
    folder first, which cuts its lineage and gives the planner its real size; a ``staged`` batch
    is read from a written table with one row per key already. Without ``order_by`` the caller
    sees to it that a key occurs once.

    Where touched partitions already hold rows, the merged partitions are written inside the
    table's folder first and then copied over the old ones. The next upsert, whichever batch it
    brings, first finishes a copy that a crash cut short. Applying a batch twice gives the same
    table, so nothing depends on batch ids, and a stream that starts over loses nothing.
    """
    spark = batch.sparkSession
    schema = batch.schema
    recover(spark, path, partition_col, sort_by)
    held = None
    if not staged:
        held = scratch_path(spark, "upsert")
        single = batch if order_by is None else newest_per_key(batch, keys, order_by)
        single.write.parquet(held)
        batch = spark.read.schema(schema).parquet(held)
    existing = read_table(spark, path, schema)
    touched = batch.select(partition_col).distinct()
    # Pruned at run time: only partitions that the batch touches are opened.
    existing = existing.join(touched, partition_col, "left_semi").select(*existing.columns)
    if existing.isEmpty():
        write_partitioned(batch, path, partition_col, sort_by, only_touched=True)
    else:
        merge(existing, batch, keys, order_by).write.mode("overwrite").parquet(_redo(path))
        recover(spark, path, partition_col, sort_by)
    if held:
        release(spark, held)
