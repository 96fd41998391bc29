"""Exact deduplication by composable polynomial fingerprints.

The fingerprint of a byte string is ``sum(byte_i + 1) * B**(n - 1 - i)`` modulo two primes. It
composes: the fingerprint of ``a + b`` is ``f(a) * B**len(b) + f(b)``. So a document is cut
into chunks, each chunk is hashed by itself, its hash is shifted by the bytes that follow it,
and a plain sum over the chunks gives the fingerprint of the whole. Chunks of huge documents
are dealt out over tasks first. Documents with equal fingerprint and length are then compared
chunk by chunk with the first of their group; a fingerprint that two texts share by accident
only costs another round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches, squeeze
from pulselake.session import stage

# Two primes below 2**31 and a base for each.
PRIMES = (2147483629, 2147483587)
BASES = (911382323, 972663749)

#: Bytes of a chunk. Sums of a chunk stay below 2**63: 2**8 * 2**31 * 2**16.
CHUNK = 1 << 16
#: Texts of more bytes have their chunks dealt out over tasks. Result-neutral.
SPREAD = 8 << 20

GROUP = ["f1", "f2", "n_bytes"]


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo ``prime``."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, prime))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step % np.uint64(prime)
        done += more
    return out


def chunk_terms(data: bytes, after: int, tables: list[np.ndarray]) -> list[int]:
    """Hashes of one chunk, shifted by the ``after`` bytes that follow it in its document."""
    if not data:
        return [0, 0]
    digits = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    out = []
    for table, base, prime in zip(tables, BASES, PRIMES):
        value = int(np.dot(digits, table[len(data) - 1 :: -1] if len(data) < len(table) else table[::-1])) % prime
        out.append(value * pow(base, after, prime) % prime if after else value)
    return out


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = [powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES)]
    for batch in batches:
        terms = [
            chunk_terms(piece, after, tables)
            for piece, after in zip(batch.column("piece").to_pylist(), batch.column("after").to_pylist())
        ]
        kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("piece", "after")]
        names = [n for n in batch.schema.names if n not in ("piece", "after")]
        both = np.array(terms, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(both[:, 0]), pa.array(both[:, 1])], [*names, "t1", "t2"]
        )


def _bodies(docs: DataFrame) -> DataFrame:
    """doc_id, normalised bytes, their number and their SHA-256."""
    return (
        docs.select("doc_id", squeeze(F.col("text")).alias("norm"))
        .select("doc_id", F.encode("norm", "UTF-8").alias("body"), F.sha2("norm", 256).alias("sha"))
        .withColumn("n_bytes", F.octet_length("body").cast("long"))
    )


def _chunks(bodies: DataFrame) -> DataFrame:
    """One row per chunk, with the number of bytes that follow it."""
    last = F.greatest(F.lit(0), F.ceil(F.col("n_bytes") / CHUNK).cast("int") - 1)
    return bodies.withColumn("idx", F.explode(F.sequence(F.lit(0), last))).select(
        *[c for c in bodies.columns if c != "body"],
        "idx",
        F.greatest(F.lit(0).cast("long"), F.col("n_bytes") - (F.col("idx") + 1) * CHUNK).alias("after"),
        F.substring("body", F.col("idx") * CHUNK + 1, F.lit(CHUNK)).alias("piece"),
    )


def fingerprints(docs: DataFrame, spread: int = SPREAD) -> DataFrame:
    """doc_id, sha, n_bytes, copies, f1, f2: one row for each distinct (doc_id, text).

    ``copies`` counts repeated rows. Their chunks are summed along with the first row's, so the
    sums are divided by ``copies`` before they are reduced.
    """
    bounded_batches(docs.sparkSession)
    long = F.coalesce(F.octet_length("text") > spread, F.lit(False))
    short_chunks = _chunks(_bodies(docs.filter(~long)))
    long_chunks = _chunks(_bodies(docs.filter(long))).repartition("doc_id", "idx")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, sha string, n_bytes long, idx int, t1 long, t2 long"
    hashed = short_chunks.mapInArrow(_hash_batches, schema).unionByName(long_chunks.mapInArrow(_hash_batches, schema))
    first = F.count(F.when(F.col("idx") == 0, True))
    return (
        hashed.groupBy("doc_id", "sha", "n_bytes")
        .agg(first.alias("copies"), F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
        .select(
            "doc_id",
            "sha",
            "n_bytes",
            "copies",
            F.expr(f"(s1 div copies) % {PRIMES[0]}").alias("f1"),
            F.expr(f"(s2 div copies) % {PRIMES[1]}").alias("f2"),
        )
    )


def _first_of(rows: DataFrame) -> DataFrame:
    """Per fingerprint: the row with the smallest doc_id (null ids last) and the number of rows."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("sha").alias("sha"))
    return rows.groupBy(*GROUP).agg(F.min(order).alias("rep"), F.count(F.lit(1)).alias("rows"))


def _compare(docs: DataFrame, pending: DataFrame) -> DataFrame:
    """``pending`` with ``same``: whether every chunk equals that of the group's first row."""
    ids = pending.select(F.col("doc_id").alias("p_id"), "f1", "f2", F.col("sha").alias("p_sha"), "rep")
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("p_id")))
    rows = _chunks(
        texts.select("doc_id", "f1", "f2", "p_sha", "rep", squeeze(F.col("text")).alias("norm"))
        .filter(F.sha2("norm", 256) == F.col("p_sha"))
        .select("doc_id", "f1", "f2", F.col("p_sha").alias("sha"), "rep", F.encode("norm", "UTF-8").alias("body"))
        .withColumn("n_bytes", F.octet_length("body").cast("long"))
    ).drop("after")
    rows = stage(rows, "dedup-chunks")  # texts of the groups only; both sides of the comparison read it
    leads = (
        rows.filter((F.col("rep.sha") == F.col("sha")) & F.col("rep.id").eqNullSafe(F.col("doc_id")))
        .groupBy(*GROUP, "idx")
        .agg(F.first("piece").alias("lead"))
    )
    leads = stage(leads, "dedup-leads")
    return (
        rows.join(leads, [*GROUP, "idx"])
        .groupBy(*GROUP, "doc_id", "sha", "rep")
        .agg(F.min(F.col("piece") == F.col("lead")).alias("same"))
    )


def groups(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text): its group's first row and whether it is that row.

    Columns: doc_id, sha, copies, keep_id, keep_sha.
    """
    prints = stage(fingerprints(docs), "fingerprints")
    first = _first_of(prints)
    marked = prints.join(first, GROUP)
    own = ["doc_id", "sha", "copies", F.col("rep.id").alias("keep_id"), F.col("rep.sha").alias("keep_sha")]
    done = marked.filter(F.col("rows") == 1).select(*own)
    pending = marked.filter(F.col("rows") > 1).drop("rows")
    while True:
        compared = stage(_compare(docs, pending), "compared")
        counted = compared.join(
            prints.select(*GROUP, F.col("doc_id").alias("c_id"), F.col("sha").alias("c_sha"), "copies"),
            (F.col("c_sha") == F.col("sha")) & F.col("c_id").eqNullSafe(F.col("doc_id")),
        ).select(*[compared[c] for c in compared.columns], "copies")
        done = done.unionByName(counted.filter("same").select(*own))
        rest = counted.filter(~F.col("same")).select(*GROUP, "doc_id", "sha", "copies")
        if compared.filter(~F.col("same")).isEmpty():
            return done
        rest = stage(rest, "unequal")
        pending = rest.join(_first_of(rest), GROUP).drop("rows")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal. Among rows with the same text the smallest doc_id stays;
    a null doc_id is last. Of rows that repeat doc_id and text exactly one is kept. Documents
    that share an id but not a text are separate. Other columns are ignored; an empty table
    gives no rows.
    """
    rows = stage(groups(docs.select("doc_id", "text")), "dedup-groups")
    sizes = rows.groupBy("keep_sha", "keep_id").agg(F.sum("copies").alias("group_size"))
    sized = rows.join(
        sizes.select(F.col("keep_sha").alias("g_sha"), F.col("keep_id").alias("g_id"), "group_size"),
        (F.col("g_sha") == F.col("keep_sha")) & F.col("g_id").eqNullSafe(F.col("keep_id")),
    )
    lead = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha"))
    return sized.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (lead & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
