"""Prefix trie of conversations, from sorted sequences and range minima over their LCPs.

Conversations are sequences of turns. Sorted, those that share a prefix of d turns stand side by
side, and the number of turns that neighbours share (LCP) tells where the prefix ends: the
members of a prefix of depth d around a place reach as far as no LCP is below d. A sparse table
holds the minima of all stretches of 1, 2, 4, ... LCPs, so every prefix finds its left and its
right end by a binary search of its own, without a stack and without its neighbours' results.

What a node reports are sums over its stretch of the sorted order. With W(j, d) the words of the
first d turns of the conversation at place j, the tokens a subtree saves are the sum of
W(j, lcp_j) - W(j, d - 1) over its places but the first; leaves are the places whose
conversation the next one doesn't extend; children are the places whose LCP is d.

The sorted order is cut into blocks by range, on (sequence, conv_id), so that many equal
conversations are cut as well. Each block is searched by itself. A prefix that reaches over a
block's edge is a prefix of the block's first or last sequence; a sparse table over the blocks'
minima finds the block it starts in, every block it reaches adds one row with its part, and the
rows of a prefix are folded in order. Only those rows, and one number of turns for each edge, go beyond
a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import WORD, bounded_batches
from pulselake.session import stage

#: Conversations c to c + FAMILY - 1 share the first turns of c.
FAMILY, HEADS = 20, 4
#: Bytes of a turn's digest in a sequence.
DIGEST = 16
#: Conversations of a block: as many as keep all cores busy, within these bounds. Result-neutral.
LEAST_BLOCK, MOST_BLOCK = 4_000, 200_000
#: Turns of a block, on average at most. Result-neutral.
BLOCK_TURNS = 2_000_000

NODE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
PART_SCHEMA = (
    "owner int, depth long, block int, n long, conv_id long, children long, leaves long, "
    "shared_words long, above_words long, ends string"
)
FOLDED_SCHEMA = (
    "owner int, depth long, n long, conv_id long, children long, leaves long, saved long, ends_sha256 string"
)
EMPTY = hashlib.sha256().hexdigest()


# --- sequences


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, key (digests of all turns in order), words (of each turn) of the rebuilt conversations.

    The first h turns of a conversation give way to those of its family's first one, as many as
    that has; h is the id's crc32 modulo 4. Turns that share a place go by role, then by digest.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            role.alias("role"),
            F.substring(F.sha2(told, 256), 1, 2 * DIGEST).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        ).alias("said"),
    )
    own = stage(
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .select("conv_id", F.transform("said", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("own")),
        "trie-turns",
    )
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("own", 1, HEADS - 1).alias("heads")
    )
    place = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    joined = own.select(
        "*", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), place.cast("int").alias("h")
    ).join(heads, "family", "left")
    none = F.lit(None).cast(joined.schema["own"].dataType)
    head = F.when(F.col("heads").isNotNull() & (F.col("h") > 0), F.slice("heads", F.lit(1), F.col("h"))).otherwise(F.slice("own", 1, 0))
    rest = F.slice("own", F.col("h") + 1, F.size("own"))
    built = joined.select("conv_id", F.coalesce(F.concat(head, rest), none).alias("turns"))
    return built.select(
        "conv_id",
        F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"),
        F.col("turns.words").alias("words"),
    )


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns at the start of two sequences that are equal."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        if a[DIGEST * low : DIGEST * mid] == b[DIGEST * low : DIGEST * mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds place and lcp to the rows of a sorted block; the keys stay at its two ends only."""
    before, place, waiting = None, 0, None
    for batch in batches:
        keys = batch.column("key").to_pylist()
        if not keys:
            continue
        lcps, edges = [], [None] * len(keys)
        for key in keys:
            lcps.append(0 if before is None else shared_turns(before, key))
            before = key
        if place == 0:
            edges[0] = keys[0]
        if waiting is not None:
            yield waiting
        waiting = pa.RecordBatch.from_arrays(
            [
                batch.column("block"),
                pa.array(range(place, place + len(keys)), pa.int64()),
                batch.column("conv_id"),
                batch.column("words"),
                pa.array(lcps, pa.int64()),
                pa.array(edges, pa.binary()),
                pa.array([None] * len(keys), pa.binary()),
            ],
            ["block", "place", "conv_id", "words", "lcp", "first_key", "last_key"],
        )
        place += len(keys)
    if waiting is not None:
        last = [None] * (waiting.num_rows - 1) + [before]
        yield waiting.set_column(waiting.num_columns - 1, "last_key", pa.array(last, pa.binary()))


def sorted_blocks(seqs: DataFrame, blocks: int) -> DataFrame:
    """The sequences in order, in blocks by range: block, place, conv_id, words, lcp, first_key, last_key."""
    dealt = seqs.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    schema = "block int, place long, conv_id long, words array<int>, lcp long, first_key binary, last_key binary"
    return dealt.withColumn("block", F.spark_partition_id()).mapInArrow(_neighbours, schema)


# --- searches


class RangeMinimum:
    """Minima of all stretches of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray):
        self.rows = [np.asarray(values, np.int64)]
        while (step := 1 << (len(self.rows) - 1)) * 2 <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each start the number of values from there on that are not below ``depth``."""
        at = np.array(start, np.int64)
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            fits = at + (1 << k) <= len(self.rows[0])
            fits &= row[np.where(fits, at, 0)] >= depth if len(row) else False
            at += fits.astype(np.int64) << k
        return at - start

    def left(self, end: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each end the number of values before it that are not below ``depth``."""
        at = np.array(end, np.int64)
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            fits = at >= 1 << k
            fits &= row[np.where(fits, at - (1 << k), 0)] >= depth if len(row) else False
            at -= fits.astype(np.int64) << k
        return end - at

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least value of each non-empty stretch."""
        level = np.frexp((stop - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), np.int64)
        for k, row in enumerate(self.rows):
            own = level == k
            out[own] = np.minimum(row[start[own]], row[stop[own] - (1 << k)])
        return out


class Edges:
    """LCPs between neighbouring blocks and the least LCP of each block, its left edge included."""

    def __init__(self, blocks: list[int], left: list[int], least: list[int]):
        self.number = {b: i for i, b in enumerate(blocks)}
        self.blocks = blocks
        self.left = [*left, -1]
        self.table = RangeMinimum(np.array(least))

    def of(self, block: int) -> tuple[int, int]:
        """LCPs at the block's left and right edge; -1 at the ends of the order."""
        i = self.number[block]
        return self.left[i], self.left[i + 1]

    def owners(self, block: int, depths: np.ndarray) -> np.ndarray:
        """The blocks in which the prefixes of these depths that reach into ``block`` start."""
        i = np.full(len(depths), self.number[block], np.int64)
        return np.array(self.blocks, np.int64)[i - 1 - self.table.left(i, depths)]


class Block:
    """One block's nodes: those that start in it, and what it holds of those that start before it."""

    def __init__(self, table: pa.Table, edges: Edges):
        table = table.sort_by("place").combine_chunks()
        self.block = int(table.column("block")[0].as_py())
        self.left, self.right = edges.of(self.block)
        words = table.column("words").chunk(0) if table.column("words").num_chunks else pa.array([], pa.list_(pa.int32()))
        self.ids = table.column("conv_id").to_numpy()
        self.size = np.diff(words.offsets.to_numpy()).astype(np.int64)
        flat = words.flatten().to_numpy().astype(np.int64)
        self.total = np.concatenate(([0], np.cumsum(flat)))
        self.base = np.concatenate(([0], np.cumsum(self.size)))
        n = len(self.ids)
        # lcp[j] is that of places j - 1 and j; both edges are included.
        self.lcp = np.concatenate((table.column("lcp").to_numpy(), [self.right])).astype(np.int64)
        self.lcp[0] = self.left
        self.table = RangeMinimum(self.lcp[1:n])
        self.least_id = RangeMinimum(self.ids)
        shared = self.words_before(np.arange(n), np.maximum(self.lcp[:n], 0))
        self.shared = np.concatenate(([0], np.cumsum(shared)))
        self.leaf = np.concatenate(([0], np.cumsum(self.lcp[1:] < self.size)))
        same = self.table.right(np.arange(n), self.size) if n else np.zeros(0, np.int64)
        #: Places from each one on that hold its very sequence.
        self.same = 1 + np.minimum(same, self._equal_run())
        self._nodes()

    def _equal_run(self) -> np.ndarray:
        """How many places right after each one hold an equal sequence, within the block."""
        n = len(self.ids)
        equal = (self.lcp[1:n] == self.size[:-1]) & (self.size[1:] == self.size[:-1])
        stops = np.append(np.flatnonzero(~equal), n - 1)
        at = np.arange(n)
        return stops[np.searchsorted(stops, at)] - at

    def words_before(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words of the first ``depth`` turns."""
        return self.total[self.base[place] + depth] - self.total[self.base[place]]

    def _nodes(self) -> None:
        n = len(self.ids)
        new = np.maximum(self.size - np.maximum(self.lcp[:n], -1), 0)
        #: place and depth of the nodes that start here, by place and depth.
        self.at = np.repeat(np.arange(n), new)
        self.first = np.concatenate(([0], np.cumsum(new)))
        self.depth = self.lcp[self.at] + 1 + np.arange(len(self.at)) - self.first[self.at]
        self.stop = self.at + 1 + self.table.right(self.at, self.depth)
        #: Nodes that go on in the next block.
        self.open = (self.stop == n) & (self.depth <= self.right)
        # A node's parent: one turn less, found to the left of the node's first place.
        above = self.depth - 1
        back = self.table.left(self.at, above)
        start = self.at - back
        self.parent_before = (start == 0) & (above <= self.left) & (above >= 0)
        own = (above >= 0) & ~self.parent_before
        self.parent = np.full(len(self.at), -1, np.int64)
        self.parent[own] = self.first[start[own]] + above[own] - self.lcp[start[own]] - 1
        self.children = np.bincount(self.parent[own], minlength=len(self.at)).astype(np.int64)
        #: Children of the nodes that start before this block, by depth.
        self.children_before = np.bincount(above[self.parent_before], minlength=max(self.left + 1, 0)).astype(np.int64)

    def _part(self, owner: int, depth: int, start: int, stop: int, skip: int, children: int) -> dict:
        """The block's share of a prefix: places ``start`` to ``stop``; ``skip`` is 1 if it starts here."""
        ends = None
        if self.size[start] == depth:
            ends = ",".join(map(str, self.ids[start : start + int(self.same[start])].tolist()))
        at = np.array([start])
        return {
            "owner": owner,
            "depth": depth,
            "block": self.block,
            "n": stop - start,
            "conv_id": int(self.ids[start:stop].min()),
            "children": children,
            "leaves": int(self.leaf[stop] - self.leaf[start]),
            "shared_words": int(self.shared[stop] - self.shared[start + skip]),
            "above_words": int(self.words_before(at, np.array([max(depth - 1, 0)]))[0]),
            "ends": ends,
        }

    def parts(self, edges: Edges) -> Iterator[dict]:
        """Shares of all prefixes that reach over one of the block's edges."""
        depths = np.arange(self.left + 1)
        if len(depths):
            stops = 1 + self.table.right(np.zeros(len(depths), np.int64), depths)
            for d, stop, owner in zip(depths.tolist(), stops.tolist(), edges.owners(self.block, depths).tolist()):
                yield self._part(owner, d, 0, stop, 0, int(self.children_before[d]))
        for node in np.flatnonzero(self.open).tolist():
            yield self._part(
                self.block, int(self.depth[node]), int(self.at[node]), len(self.ids), 1, int(self.children[node])
            )

    def nodes(self, edges: Edges, folded: dict[tuple[int, int], dict]) -> pa.Table:
        """All nodes that start in the block; ``folded`` has the prefixes that reach over its edges."""
        count = self.stop - self.at
        conv = self.least_id.least(self.at, self.stop) if len(self.at) else np.zeros(0, np.int64)
        leaves = self.leaf[self.stop] - self.leaf[self.at]
        above = self.words_before(self.at, np.maximum(self.depth - 1, 0))
        saved = self.shared[self.stop] - self.shared[self.at + 1] - (count - 1) * above
        children = self.children.copy()
        ends = [EMPTY] * len(self.at)
        for node in np.flatnonzero((self.size[self.at] == self.depth) & ~self.open).tolist():
            at = int(self.at[node])
            members = self.ids[at : at + int(self.same[at])].tolist()
            ends[node] = hashlib.sha256(",".join(map(str, members)).encode()).hexdigest()
        for node in np.flatnonzero(self.open).tolist():
            row = folded[self.block, int(self.depth[node])]
            count[node], conv[node], children[node] = row["n"], row["conv_id"], row["children"]
            leaves[node], saved[node], ends[node] = row["leaves"], row["saved"], row["ends_sha256"]
        parent = np.zeros(len(self.at), np.int64)
        own = self.parent >= 0
        parent[own] = conv[self.parent[own]]
        depths = np.arange(self.left + 1)
        if len(depths):
            owners = edges.owners(self.block, depths).tolist()
            before = np.array([folded[o, d]["conv_id"] for d, o in enumerate(owners)], np.int64)
            parent[self.parent_before] = before[self.depth[self.parent_before] - 1]
        columns = [conv, self.depth, pa.array(parent, mask=self.depth == 0), count, children, leaves, saved]
        return pa.table([*map(pa.array, columns), pa.array(ends, pa.string())], names=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each (owner, depth) of rows sorted by (owner, depth, block). Holds one prefix at a time."""
    names = [c.split()[0] for c in FOLDED_SCHEMA.split(", ")]

    def closed(row: dict, digest) -> dict:
        saved = row["shared_words"] - (row["n"] - 1) * row["above_words"]
        return row | {"saved": saved, "ends_sha256": digest.hexdigest()}

    at, digest, some = None, None, False
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if at is None or (row["owner"], row["depth"]) != (at["owner"], at["depth"]):
                if at is not None:
                    done.append(closed(at, digest))
                at, digest, some = row, hashlib.sha256(), False
            else:
                for name in ("n", "children", "leaves", "shared_words"):
                    at[name] += row[name]
                at["conv_id"] = min(at["conv_id"], row["conv_id"])
            if ends := row.pop("ends"):
                digest.update(("," * some + ends).encode())
                some = True
        yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in done], _arrow(FOLDED_SCHEMA))
    if at is not None:
        row = closed(at, digest)
        yield pa.RecordBatch.from_pylist([{n: row[n] for n in names}], _arrow(FOLDED_SCHEMA))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _edges(blocks: DataFrame) -> Edges:
    """One number for each edge and block comes to the driver, and two sequences of digests."""
    rows = (
        blocks.groupBy("block")
        .agg(
            F.max("first_key").alias("first_key"),
            F.max("last_key").alias("last_key"),
            F.min(F.when(F.col("place") > 0, F.col("lcp"))).alias("least"),
        )
        .orderBy("block")
        .collect()
    )
    left = [-1] + [shared_turns(bytes(a["last_key"]), bytes(b["first_key"])) for a, b in zip(rows, rows[1:])]
    least = [edge if r["least"] is None else min(edge, r["least"]) for edge, r in zip(left, rows)]
    return Edges([r["block"] for r in rows], left, least)


def prefix_trie(conversations: DataFrame, block_rows: int | None = None) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Null roles and texts count as empty; turns go by ``turn``, nulls first, then by role
    and digest of the text, and repeated rows are turns of their own. Rows without a conv_id are in no
    conversation. A conversation left without turns is a member of the root. An empty table
    has no nodes. Other columns are ignored, texts are taken whole. A conversation's
    sequence takes 16 bytes a turn and is one value. conv_id is a whole number.
    """
    spark = conversations.sparkSession
    bounded_batches(spark)
    seqs = stage(sequences(conversations), "trie-sequences")
    n, turns = seqs.agg(F.count("*"), F.sum(F.size("words"))).first()
    if n == 0:
        return spark.createDataFrame([], NODE_SCHEMA)
    each = block_rows or min(MOST_BLOCK, max(LEAST_BLOCK, n // (4 * spark.sparkContext.defaultParallelism)))
    parts = max(-(-n // each), -(-turns // BLOCK_TURNS))
    blocks = stage(sorted_blocks(seqs, parts), "trie-blocks")
    edges = _edges(blocks)
    rows = blocks.select("block", "place", "conv_id", "words", "lcp")

    def parts_of(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(Block(table, edges).parts(edges)), _arrow(PART_SCHEMA))

    shares = stage(rows.groupBy("block").applyInArrow(parts_of, PART_SCHEMA), "trie-parts")
    folded = shares.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block").mapInArrow(_fold, FOLDED_SCHEMA)
    told = stage(shares.select("owner", "depth", "block").join(folded, ["owner", "depth"]), "trie-folded")

    def nodes_of(table: pa.Table, across: pa.Table) -> pa.Table:
        found = {(r["owner"], r["depth"]): r for r in across.to_pylist()}
        return Block(table, edges).nodes(edges, found)

    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(nodes_of, NODE_SCHEMA)
