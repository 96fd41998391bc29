"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints within ``BUDGET`` differing bits agree in at least one of ``BUDGET + 1`` bands of
16 bits. So each fingerprint is turned until a band leads, once for each band, and the trie of
all fingerprints is entered at the nodes of depth 16: only a node paired with itself has budget
left, and each such node is a subtree that a task can search alone. There the self-join walks
pairs of nodes downward together, adds a differing bit where the pair parts ways, and drops the
pair when the budget is exceeded. A subtree with very many fingerprints is dealt into blocks,
and every pair of its blocks is searched by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches, pieces
from pulselake.session import stage

# Shingle length, seed of XXH64, bits that may differ, bits of a fingerprint.
SHINGLE = 3
SEED = 42
BUDGET = 3
BITS = 64
BAND = BITS // (BUDGET + 1)

#: Fingerprints of a subtree that one task searches; larger ones are dealt into blocks.
BLOCK = 2048
#: Rows of all the subtrees that one call of the search gets, about.
CALL_ROWS = 4096
#: Hashes counted at a time, and node pairs walked at a time. All of these are result-neutral.
HASHES = 1 << 15
FRONTIER = 1 << 18


def fingerprint(text: bytes | None) -> int:
    """The SimHash of a text, unsigned."""
    words = (text or b"").lower().split()  # on bytes: A-Z only, and splits at ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    ones = np.zeros(BITS, np.int64)
    total = len(words) - SHINGLE + 1
    for start in range(0, total, HASHES):
        part = words[start : start + HASHES + SHINGLE - 1]
        hashes = [digest(b" ".join(s), SEED) for s in zip(part, part[1:], part[2:])]
        raw = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column(0).to_pylist()]
        values = np.array(prints, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(values)], [*batch.schema.names[1:], "fp"]
        )


def fingerprints(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` and fp, the fingerprint as a signed long; zero for texts without words."""
    bounded_batches(docs.sparkSession)
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    rows = docs.select(F.col("text").cast("binary").alias("body"), *carry)
    return rows.mapInArrow(_print_batches, ", ".join([*kinds, "fp long"]))


class _Walk:
    """Pairs of nodes of tries that stand one after the other in sorted arrays.

    A node of depth d is a run of ``values`` with the same leading d bits in one trie. ``first``
    bits are the same in all of a trie.
    """

    def __init__(self, values: np.ndarray, first: int) -> None:
        self.values, self.first = values, first
        self.ones: dict[int, np.ndarray] = {}

    def split(self, depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Where the ones of bit ``depth`` begin in each run."""
        if depth not in self.ones:
            bit = (self.values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        ones = self.ones[depth]
        return hi - (ones[hi] - ones[lo])

    def links(self, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs within the budget. ``pairs``: columns a_lo, a_hi, b_lo, b_hi, errors."""
        todo = [(self.first, pairs)]
        while todo:
            depth, now = todo.pop()
            if len(now) > FRONTIER:
                todo += [(depth, now[i : i + FRONTIER]) for i in range(0, len(now), FRONTIER)]
                continue
            alo, ahi, blo, bhi, err = now.T
            small = (ahi - alo) * (bhi - blo) <= 16 if depth < BITS else np.ones(len(now), bool)
            if small.any():
                yield from self._leaves(now[small])
                now = now[~small]
                alo, ahi, blo, bhi, err = now.T
            if not len(now):
                continue
            amid, bmid = self.split(depth, alo, ahi), self.split(depth, blo, bhi)
            self_pair = alo == blo
            parts = [
                np.stack([alo, amid, blo, bmid, err], 1),
                np.stack([amid, ahi, bmid, bhi, err], 1),
                np.stack([alo, amid, bmid, bhi, err + 1], 1),
                np.stack([amid, ahi, blo, bmid, err + 1], 1)[~self_pair],
            ]
            below = np.concatenate(parts)
            alive = (below[:, 4] <= BUDGET) & (below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3])
            alive &= ~((below[:, 0] == below[:, 2]) & (below[:, 1] - below[:, 0] == 1))  # one value and itself
            if alive.any():
                todo.append((depth + 1, below[alive]))

    def _leaves(self, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Compare the few values below each pair directly."""
        wide = (pairs[:, 3] - pairs[:, 2]).astype(np.int64)
        count = (pairs[:, 1] - pairs[:, 0]) * wide
        stop = np.cumsum(count)
        cut = 0
        while cut < len(pairs):  # so many pairs at a time that the arrays stay small
            upto = max(cut + 1, int(np.searchsorted(stop, (stop[cut - 1] if cut else 0) + 4 * FRONTIER)))
            own, n = pairs[cut:upto], count[cut:upto]
            at = np.repeat(np.arange(len(own)), n)
            k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            i = own[at, 0] + k // wide[cut:upto][at]
            j = own[at, 2] + k % wide[cut:upto][at]
            near = np.bitwise_count(self.values[i] ^ self.values[j]) <= BUDGET
            near &= (own[at, 0] != own[at, 2]) | (i < j)
            yield i[near], j[near]
            cut = upto


def _settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of linked positions, in place; ``label`` holds every position's root."""
    while True:
        i, j = label[i], label[j]
        apart = i != j
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(label, np.maximum(i, j), np.minimum(i, j))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of all subtrees in ``rows`` (turn, band, low, high, side, fp): a spanning star each."""
    turn = rows["turn"].to_numpy()
    fp = rows["fp"].to_numpy().view(np.uint64)
    by = np.uint64(BAND) * turn.astype(np.uint64)
    turned = np.where(turn == 0, fp, (fp << by) | (fp >> (np.uint64(BITS) - np.where(turn == 0, np.uint64(1), by))))
    low, high, side = (rows[c].to_numpy() for c in ("low", "high", "side"))
    order = np.lexsort((turned, side, high, low, turned >> np.uint64(BITS - BAND), turn))
    turned, fp, turn, low, high, side = (x[order] for x in (turned, fp, turn, low, high, side))
    band = turned >> np.uint64(BITS - BAND)
    new = np.ones(len(fp) + 1, bool)
    new[1:-1] = (
        (band[1:] != band[:-1])
        | (turn[1:] != turn[:-1])
        | (low[1:] != low[:-1])
        | (high[1:] != high[:-1])
        | (side[1:] != side[:-1])
    )
    edges = np.flatnonzero(new)
    lo, hi = edges[:-1], edges[1:]
    zero = np.zeros(len(lo), np.int64)
    own = low[lo] == high[lo]
    pairs = np.stack([lo, hi, lo, hi, zero], 1)[own & (hi - lo > 1)]
    # A pair of blocks stands as two runs that follow one another.
    left = np.flatnonzero(~own & (side[lo] == 0))
    left = left[left + 1 < len(lo)]
    same = np.array([], np.int64)
    if len(left):
        a, b = lo[left], lo[left + 1]
        match = (turn[a] == turn[b]) & (band[a] == band[b]) & (low[a] == low[b]) & (high[a] == high[b])
        same = left[match]
    pairs = np.concatenate([pairs, np.stack([lo[same], hi[same], lo[same + 1], hi[same + 1], zero[same]], 1)])
    label = np.arange(len(fp))
    for i, j in _Walk(turned, BAND).links(pairs):
        _settle(label, i, j)
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[label[moved]].view(np.int64)})


def links(prints: DataFrame) -> DataFrame:
    """Edges a, b between distinct fingerprints whose components are those of all links.

    ``prints``: a staged table with distinct ``fp``. Within one task linked fingerprints come as
    a star, so a dense cluster gives as many edges as fingerprints.
    """
    turns = F.array(*[F.lit(i) for i in range(BUDGET + 1)])
    lead = F.expr(f"shiftrightunsigned(fp, {BITS - BAND} - {BAND} * turn) & {(1 << BAND) - 1}")
    turned = prints.select("fp", F.explode(turns).alias("turn")).withColumn("band", lead.cast("int"))
    large = turned.groupBy("turn", "band").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    large = large.select(
        F.col("turn").alias("l_turn"), F.col("band").alias("l_band"), F.ceil(F.col("n") / BLOCK).cast("int").alias("m")
    )
    blocks = turned.join(
        large, (F.col("turn") == F.col("l_turn")) & (F.col("band") == F.col("l_band")), "left"
    ).withColumn("m", F.coalesce("m", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("m")).cast("int")
    cells = (
        blocks.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .select(
            "turn",
            "band",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            (F.col("mine") > F.col("other")).cast("int").alias("side"),
            "fp",
        )
    )
    calls = pieces((BUDGET + 1) * prints.count(), CALL_ROWS)
    call = F.pmod(F.xxhash64("turn", "band", "low", "high"), F.lit(calls))
    found = cells.withColumn("call", call).groupBy("call").applyInPandas(lambda rows: _search(rows), "a long, b long")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each connected component, for nodes with an edge.

    Alternates large-star and small-star steps until no edge changes. Every step is one
    aggregation and one join on a node, and its edges are written to the shared folder.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
        large = both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(least, F.col("u") == F.col("w")).select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        now = stage(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, group, and ``carry``.

    ``group`` is a fingerprint that names the component.

    ``component_id`` is the smallest doc_id reachable over links of at most ``BUDGET`` differing
    bits, its own included. Texts without words, and null texts, have fingerprint zero and are
    linked like any other. A null doc_id is never the smallest unless all of its component are
    null. Repeated rows stay rows. An empty table gives no rows. Other columns are ignored.
    """
    carry = ["doc_id", *(carry or [])]
    prints = stage(fingerprints(docs, carry), "simhash")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "h_root")
    named = rooted.join(heads, F.col("root") == F.col("h_root")).select(
        F.col("fp").alias("n_fp"), "component_id", F.col("root").alias("group")
    )
    return prints.join(named, F.col("fp") == F.col("n_fp")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group",
        *carry[1:],
    )
