"""Small helpers the operators of this package share."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space and words of the query contracts.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: The same set as a Python pattern on bytes; ``bytes.split()`` splits on exactly these.
SPACES_BYTES = re.compile(rb"[\x20\x09-\x0D]+")

#: Most bytes Spark puts into one Arrow batch for a Python worker, so that very long texts
#: come a few at a time. Result-neutral.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit the bytes of an Arrow batch; call before a plan with Python in it is built."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def squeeze(text: Column) -> Column:
    """Every white-space run replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def crc_bucket(ident: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % parts


def unit_hash(*cols: Column) -> Column:
    """A repeatable number in (0, 1) from the columns."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def pieces(total: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` rows ``total`` rows make."""
    return max(least, math.ceil(total / each))


def offsets(rows: list, key: str, *values: str) -> dict:
    """Running totals before each key, for a table with one row per range or partition."""
    out, sums = {}, [0] * len(values)
    for row in sorted(rows, key=lambda r: r[key]):
        out[row[key]] = tuple(sums)
        sums = [s + row[v] for s, v in zip(sums, values)]
    return out


#: Bits of a key filter. Its table has at most 1/64 as many rows, so it may be broadcast.
FILTER_BITS = 1 << 23


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """f_word, f_mask: a bitmap of hashed keys, of bounded size for any number of keys."""
    spot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    words = keys.select(F.shiftright(spot, 6).alias("f_word"), F.expr(f"shiftleft(1L, cast({_bit(key)} as int))").alias("bit"))
    return words.groupBy("f_word").agg(F.bit_or("bit").alias("f_mask"))


def _bit(key: str) -> str:
    return f"pmod(xxhash64({key}), {FILTER_BITS}L) & 63"


def maybe_in(rows: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """``rows`` with ``hit``: false only if ``key`` is not among those of the filter.

    Rows without a hit need not take part in a join on the key. A filter that fills up passes
    more rows; the join decides.
    """
    word = F.shiftright(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)), 6)
    bit = F.expr(f"f_mask & shiftleft(1L, cast({_bit(key)} as int))")
    joined = rows.join(F.broadcast(found), word == F.col("f_word"), "left")
    return joined.withColumn("hit", F.coalesce(bit != 0, F.lit(False))).drop("f_word", "f_mask")
