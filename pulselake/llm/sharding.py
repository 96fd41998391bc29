"""Sharding by sampled splitters.

Records are ordered by a key. A sample in which a record's chance grows with its size gives
quantile boundaries; records are dealt into the ranges between them, and ranges that still hold
too much are sampled again and subdivided. Exact sums over the ranges then say where in which
range each shard ends, so the shards are equal to within a record and not just on average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.common import offsets, pieces, unit_hash
from pulselake.session import stage

#: Rows of a range, about, and the most ranges; with more rows the ranges get longer.
RANGE_ROWS = 4096
MOST_RANGES = 1 << 16
#: Sampled keys for each range. With MOST_RANGES it bounds what the driver gets.
SAMPLES = 16
#: A range is overfull from this multiple of the mean on.
OVERFULL = 3
#: Records with the same text stay together at a shard's end if they are at most this share of it.
WHOLE = 0.05


def order_key(text: Column, ident: Column) -> Column:
    """Sortable key of fixed length: digest of the text, then the id (null first).

    Equal texts are neighbours, and even a text that many records share can be cut between
    records.
    """
    # The sign bit is turned, so that hexadecimal digits sort as the numbers do.
    digits = F.lpad(F.hex(ident.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.md5(text), F.coalesce(digits, F.lit("-" * 16)))


def records(docs: DataFrame) -> DataFrame:
    """doc_id, key, size, text_crc32; size is UTF-8 bytes plus one."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        order_key(body, F.col("doc_id")).alias("key"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )


def _dealt(rows: DataFrame, bounds: list[str]) -> DataFrame:
    """``rows`` with ``range``: how many boundaries are at or below the key."""
    edges = np.array(bounds, dtype="S48")
    at = rows.columns.index("key")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column(at).to_pylist(), dtype="S48")
            places = np.searchsorted(edges, keys, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], [*batch.schema.names, "range"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(find, f"{schema}, range int")


def _quantiles(keys: list[str], each: int) -> list[str]:
    keys = sorted(keys)
    return keys[each - 1 :: each]


def splitters(rows: DataFrame) -> tuple[DataFrame, list]:
    """``rows`` dealt into ranges, and rows, bytes of every range.

    The driver gets at most about ``MOST_RANGES * SAMPLES`` keys.
    """
    n_rows, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(pieces(n_rows, RANGE_ROWS, 256), MOST_RANGES)
    chance = F.col("size") * (ranges * SAMPLES / max(total, 1))
    drawn = rows.filter(unit_hash("key", F.lit("first")) < chance).select("key").collect()
    bounds = sorted(set(_quantiles([r["key"] for r in drawn], SAMPLES)))
    while True:
        dealt = _dealt(rows, bounds)
        held = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()
        full = {r["range"]: max(r["n"] / max(n_rows, 1), r["bytes"] / max(total, 1)) * ranges for r in held}
        full = {k: v for k, v in full.items() if v > OVERFULL}
        if not full or len(bounds) >= MOST_RANGES:
            return dealt, held
        # Row-weighted this time: many small records may fill a range that is light in bytes.
        counts = {r["range"]: r["n"] for r in held}
        rates = rows.sparkSession.createDataFrame(
            [(k, min(1.0, v * SAMPLES / counts[k])) for k, v in full.items()], "f_range int, rate double"
        )
        chosen = dealt.join(F.broadcast(rates), F.col("range") == F.col("f_range"))  # MOST_RANGES rows at most
        more = chosen.filter(unit_hash("key", F.lit(len(bounds))) < F.col("rate")).select("range", "key").collect()
        by_range: dict[int, list[str]] = {}
        for r in more:
            by_range.setdefault(r["range"], []).append(r["key"])
        new = {key for keys in by_range.values() for key in _quantiles(keys, SAMPLES)} - set(bounds)
        if not new:  # records with one and the same key can't be cut apart
            return dealt, held
        bounds = sorted({*bounds, *new})


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: shards of nearly equal bytes.

    A record belongs to the shard that holds its middle byte, in the order of ``order_key``. At
    most ``shards - 1`` texts lie across an end; such a text stays in one shard if its copies
    are small beside a shard (``WHOLE``), and is cut between records otherwise. Null text counts
    as empty. Repeated rows are records of their own. An empty table gives no rows. Other
    columns are ignored.
    """
    rows = stage(records(docs), "shard-records")
    dealt, held = splitters(rows)
    starts = offsets(held, "range", "n", "bytes")
    total = sum(r["bytes"] for r in held)
    table = docs.sparkSession.createDataFrame(
        [(k, *v) for k, v in starts.items()], "s_range int, s_row long, s_byte long"
    )
    within = Window.partitionBy("range").orderBy("key", "size")
    upto = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("l_row", F.row_number().over(within) - 1)
        .withColumn("l_byte", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .join(table, F.col("range") == F.col("s_range"))
        .withColumn("row", F.col("s_row") + F.col("l_row"))
        .withColumn("byte", F.col("s_byte") + F.col("l_byte"))
        .withColumn("text_key", F.substring("key", 1, 32))
        .withColumn("shard", _middle(F.col("byte"), F.col("size"), total, shards))
        .select("doc_id", "size", "text_crc32", "text_key", "row", "byte", "shard")
    )
    placed = stage(placed, "shard-placed")
    # The order is one of texts, so each of the shards' ends lies in one text at most.
    cut = (
        placed.groupBy("text_key")
        .agg(
            F.min("shard").alias("low"),
            F.max("shard").alias("high"),
            F.min("byte").alias("byte"),
            F.sum("size").alias("size"),
        )
        .filter("low < high")
        .collect()
    )
    final = F.col("shard")
    for text in cut:
        if text["size"] <= WHOLE * total / shards:
            home = min(shards - 1, (2 * text["byte"] + text["size"]) * shards // (2 * total))
            final = F.when(F.col("text_key") == text["text_key"], F.lit(home)).otherwise(final)
    placed = placed.withColumn("shard", final.cast("int"))
    firsts = placed.groupBy(F.col("shard").alias("f_shard")).agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), F.col("shard") == F.col("f_shard")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _middle(byte: Column, size: Column, total: int, shards: int) -> Column:
    spot = (byte * 2 + size).cast("decimal(30,0)") * shards
    return F.least(F.floor(spot / F.lit(max(2 * total, 1)).cast("decimal(20,0)")).cast("int"), F.lit(shards - 1))


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write every record with its shard and slot, one folder per shard, sorted by slot.

    Records are found again by doc_id, which must be unique here.
    """
    where = shard(docs, shards).select(F.col("doc_id").alias("w_id"), "shard", "slot")
    joined = docs.join(where, F.col("doc_id").eqNullSafe(F.col("w_id"))).drop("w_id")
    joined.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
