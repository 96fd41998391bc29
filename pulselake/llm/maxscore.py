"""Exact top-k search by inner product with MaxScore.

Vectors are treated as documents and their components as terms: dimension ``d`` has two posting
lists, one for positive and one for negative components, so that a query's component only ever
gains from one of them. A query's terms are ordered by the most they can add. Those that even
together can't lift a vector into the top k are non-essential: vectors are found through the
postings of the essential terms only, and the other terms are looked up while a vector can still
compete. Rows are dealt into shards, queries into blocks; each shard's best k are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.common import pieces
from pulselake.session import stage

SCALE = 1024
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
TOP = 10
#: Every how many ids a row is a query.
QUERY_STEP = 100
#: Rows of a shard and queries of a block, about. Result-neutral.
SHARD_ROWS = 2048
BLOCK_QUERIES = 1024


class Shard:
    """Vectors of one shard with postings by dimension and sign."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.postings = []
        for column in self.rows.T:
            lists = []
            for sign in (1, -1):
                at = np.flatnonzero(column * sign > 0)
                lists.append((at, column[at], int(abs(column[at]).max()) if len(at) else 0))
            self.postings.append(lists)

    def top(self, own: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """Up to k of (score, id), best first. ``floor``: a score that k other rows are known to reach."""
        gains = [
            (int(abs(q)) * self.postings[d][0 if q > 0 else 1][2], d) for d, q in enumerate(query.tolist()) if q
        ]
        gains.sort()
        # Terms up to ``spare`` can't lift a vector above the floor by themselves.
        spare = 0
        rest = 0
        if floor is not None:
            while spare < len(gains) and rest + gains[spare][0] < floor:
                rest += gains[spare][0]
                spare += 1
        total = np.zeros(len(self.ids), self.rows.dtype)
        met = np.zeros(len(self.ids), bool)
        if floor is None or floor <= 0:  # a vector in no posting at all scores zero or less, and may compete
            met[:] = True
        for _, d in gains[spare:]:
            at, values, _ = self.postings[d][0 if query[d] > 0 else 1]
            total[at] += values * query[d]
            met[at] = True
        met &= self.ids != own
        alive = np.flatnonzero(met)
        if floor is not None:
            alive = alive[total[alive] + rest >= floor]
        score = total[alive]
        # Losses of the essential terms, then the other terms, largest first.
        for gain, d in [(0, d) for _, d in gains[spare:]] + [(g, d) for g, d in gains[:spare][::-1]]:
            if not len(alive):
                break
            part = self.rows[alive, d] * query[d]
            score = score + (part if gain else np.minimum(part, 0))
            if gain:
                rest -= gain
            if floor is not None:
                keep = score + rest >= floor
                alive, score = alive[keep], score[keep]
        best = np.argsort(-score, kind="stable")[:k]  # stands in the order of ids
        return [(int(score[i]), int(self.ids[alive[i]])) for i in best]


def _numbers(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros. Exact: large ones as Python's integers."""
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    small = -(1 << 26) < out.min(initial=0) and out.max(initial=0) < 1 << 26
    return out if small else out.astype(object)


def _search(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            width = max(queries["q_vector"].map(len).max(), rows["vector"].map(len).max())
            q_rows, r_rows = _numbers(queries["q_vector"], width), _numbers(rows["vector"], width)
            ids = rows["vec_id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            ids, r_rows = ids[order], r_rows[order]
            # A few rows compared in full give the score that the others have to reach.
            seeds = 4 * k
            scores = q_rows @ r_rows[:seeds].T
            rest = Shard(ids[seeds:], r_rows[seeds:])
            for own, query, seeded in zip(queries["query_id"].tolist(), q_rows, scores):
                found = [(int(s), i) for s, i in zip(seeded, ids[:seeds].tolist()) if i != own]
                found = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
                floor = found[k - 1][0] if len(found) == k else None
                found = sorted(found + rest.top(own, query, k, floor), key=lambda x: (-x[0], x[1]))[:k]
                out += [(own, ident, max(LOWEST, min(HIGHEST, score))) for score, ident in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def vectors(table: DataFrame, k: int = TOP) -> DataFrame:
    """vec_id, vector, copy: the components as ``floor(1024 * x)``; rows that take no part are left out.

    Equal rows are numbered by ``copy``. More than ``k`` of them can't be told apart in any result.
    """
    doubles = F.col("embedding").cast("array<double>")
    whole = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(whole)
        .select("vec_id", F.transform(doubles, lambda x: F.floor(x * SCALE).cast("long")).alias("vector"))
        .groupBy("vec_id", "vector")
        .agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
        .select("vec_id", "vector", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    )


def top_k(table: DataFrame, k: int = TOP, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id ``step`` divides, the ``k`` best others.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows
    without an id. All rows that share an id are candidates, with a rank for each, but never
    for a query of that id; if several rows share a query's id, the best of all their scores count.
    Vectors of different length are compared as if the shorter ended in zeros. Components and scores beyond
    a long become the nearest long. Fewer than ``k`` other rows give fewer ranks, an empty table
    none; other columns are ignored.
    """
    rows = stage(vectors(table.select("vec_id", "embedding"), k), "vectors")
    total = rows.count()
    shards = pieces(total, SHARD_ROWS)
    queries = rows.filter(F.col("vec_id") % step == 0).select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"), "copy"
    )
    blocks = pieces(queries.count(), BLOCK_QUERIES)
    # Every shard meets every block: a grid of small cells, each side dealt to the cells of its line.
    q_cells = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "q_vector", "copy"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    )
    r_cells = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector", "copy"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )
    found = (
        q_cells.groupBy("block", "shard")
        .cogroup(r_cells.groupBy("block", "shard"))
        .applyInPandas(_search(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
