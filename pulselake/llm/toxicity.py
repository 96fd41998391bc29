"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words and the beginnings of its words, hashed; those that make up a large
share of the text are terms of their own beside that. The score is the logistic of
``bias + sum w_i + sum_{i<j} <v_i, v_j>`` over the terms present, so that two terms which are
harmless alone can be toxic together. Only the buckets that tell the labels apart best in the
training rows get weights; all others are zero.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches, crc_bucket
from pulselake.session import stage

BUCKETS = 1 << 20
#: Word beginnings of so many letters are terms beside the word itself.
STEMS = (4, 5, 6, 7, 8)
#: A word or beginning is frequent in a text from so many occurrences and one in so many words on.
FREQUENT, ONE_IN = 2, 128
#: Labelled rows the model is fitted on, buckets that get weights, rows a bucket must be in.
SAMPLE_ROWS = 20_000
FEATURES = 2048
LEAST_ROWS = 3
#: Log-likelihood ratio that a bucket needs: below, chance alone would fill the machine with noise.
LEAST_RATIO = 6.0
FACTORS = 8
EPOCHS = 24
# Step, penalties, rows of a step.
STEP, L2_LINEAR, L2_FACTORS, BATCH = 0.2, 1e-5, 1e-4, 64
TOXIC = 0.7
#: Words whose buckets a worker remembers. Result-neutral.
MEMO = 400_000

LETTERS = re.compile(r"[^\W\d_]+")
#: Characters of a text looked at at a time.
PIECE = 1 << 20


@dataclass
class Machine:
    places: dict[int, int]  # bucket -> feature
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, present: list[int]) -> float:
        total = self.bias
        if present:
            v = self.factors[present]
            s = v.sum(axis=0)
            total += self.linear[present].sum() + 0.5 * float(s @ s - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


def words(text: str | None) -> Counter[str]:
    """Words, lower-cased, and how often each stands there: runs of letters, whatever stands around them."""
    out: Counter[str] = Counter()
    at, n = 0, len(text or "")
    while at < n:
        upto = min(n, at + PIECE)
        while upto < n and text[upto - 1].isalpha() and upto - at < 2 * PIECE:
            upto += 1  # don't cut a word
        out.update(LETTERS.findall(text[at:upto].lower()))
        at = upto
    return out


def terms(word: str) -> tuple[list[int], list[int]]:
    """Buckets of a word's presence, its own and those of its beginnings, and of their frequent use."""
    parts = [b"w" + word.encode("utf-8", "replace")]
    parts += [b"s" + word[:n].encode("utf-8", "replace") for n in STEMS if len(word) >= n]
    present, frequent = ([zlib.crc32(kind + p) & (BUCKETS - 1) for p in parts] for kind in (b"", b"f"))
    return present, frequent


class Lookup:
    """Features of a text; remembers a bounded number of words."""

    def __init__(self, places: dict[int, int] | None) -> None:
        self.places, self.seen = places, {}

    def _word(self, word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        present, frequent = terms(word)
        if self.places is not None:
            present, frequent = ([self.places[b] for b in found if b in self.places] for found in (present, frequent))
        if len(self.seen) >= MEMO:
            self.seen.clear()
        self.seen[word] = found = (tuple(present), tuple(frequent))
        return found

    def of(self, text: str | None) -> list[int]:
        out: set[int] = set()
        counted = words(text)
        often: dict[int, int] = {}
        for word, n in counted.items():
            present, frequent = self.seen.get(word) or self._word(word)
            out.update(present)
            for b in frequent:
                often[b] = often.get(b, 0) + n
        least = max(FREQUENT, counted.total() / ONE_IN)
        out.update(b for b, n in often.items() if n >= least)
        return sorted(out)


def held_out() -> Column:
    """Whether a document's label may not be learned from."""
    return crc_bucket(F.col("doc_id"), 3) == 1


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic of at most about ``rows`` labelled documents that may be learned from."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    chosen = stage(known.filter(draw < share).select(F.col("doc_id").alias("l_id"), "toxic"), "toxic-sample")
    # About ``rows`` ids and labels at most, whatever the tables' size.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    return found.select("text", "toxic")


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = np.zeros((2, BUCKETS), np.int32)
    rows = np.zeros(2, np.int64)
    look = Lookup(None)
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            label = int(toxic > 0)
            tally[label, look.of(text)] += 1
            rows[label] += 1
    at = np.flatnonzero(tally.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), *(pa.array(np.append(tally[k, at], rows[k]).astype(np.int64)) for k in (0, 1))],
        ["bucket", "clean", "toxic"],
    )


def choose(rows: DataFrame, features: int = FEATURES) -> dict[int, int]:
    """The buckets that most speak for the label, by log-likelihood ratio, numbered."""
    tallies = rows.mapInArrow(_tallies, "bucket long, clean long, toxic long")
    sums = tallies.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sums = stage(sums, "toxic-terms")  # BUCKETS rows at most
    whole = sums.filter("bucket = -1").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        return {}
    clean, toxic = float(whole["clean"]), float(whole["toxic"])
    seen = F.col("clean") + F.col("toxic")

    def part(n: Column, mean: Column) -> Column:
        return F.when(n > 0, n * F.log(n / mean)).otherwise(0.0)

    ratio = sum(
        part(n, total * m / (clean + toxic))
        for n, total, m in (
            (F.col("toxic"), seen, toxic),
            (F.col("clean"), seen, clean),
            (toxic - F.col("toxic"), clean + toxic - seen, toxic),
            (clean - F.col("clean"), clean + toxic - seen, clean),
        )
    )
    best = (
        sums.filter((F.col("bucket") >= 0) & (seen >= LEAST_ROWS))
        .filter(F.col("toxic") * (clean + toxic) > seen * toxic)
        .select("bucket", ratio.alias("ratio"))
        .filter(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "bucket")
        .limit(features)
        .collect()
    )
    return {r["bucket"]: i for i, r in enumerate(best)}


def fit(present: list[list[int]], labels: np.ndarray, features: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, linear weights and factors by AdaGrad on the logistic loss."""
    draw = np.random.default_rng(11)
    rate = labels.mean() if len(labels) else 0.5
    bias = float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6)))
    w, v = np.zeros(features), draw.normal(0, 0.05, (features, FACTORS))
    gw, gv, gb = np.full(features, 1e-6), np.full((features, FACTORS), 1e-6), 1e-6
    order = np.arange(len(labels))
    for _ in range(EPOCHS):
        draw.shuffle(order)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x = np.zeros((len(rows), features))
            for k, r in enumerate(rows):
                x[k, present[r]] = 1.0
            used = np.flatnonzero(x.any(axis=0))
            x, vu = x[:, used], v[used]
            s = x @ vu
            score = bias + x @ w[used] + 0.5 * (s * s - x @ (vu * vu)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - labels[rows]) / len(rows)
            d_w = x.T @ error + L2_LINEAR * w[used]
            d_v = x.T @ (error[:, None] * s) - vu * (x.T @ error)[:, None] + L2_FACTORS * vu
            gb += error.sum() ** 2
            bias -= STEP * error.sum() / np.sqrt(gb)
            gw[used] += d_w**2
            w[used] -= STEP * d_w / np.sqrt(gw[used])
            gv[used] += d_v**2
            v[used] -= STEP * d_v / np.sqrt(gv[used])
    return bias, w, v


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Machine:
    """A machine from at most about ``rows`` labelled rows; scores 0.5 if there is one label only."""
    bounded_batches(docs.sparkSession)
    chosen = training_rows(docs, labels, rows)
    places = choose(chosen, features)
    if not places:
        return Machine({}, 0.0, np.zeros(0), np.zeros((0, FACTORS)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(places)
        for batch in batches:
            found = [look.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column("toxic")], ["present", "toxic"]
            )

    kind = chosen.schema["toxic"].dataType.simpleString()
    drawn = chosen.mapInArrow(find, f"present array<int>, toxic {kind}").collect()
    drawn.sort(key=lambda r: (r["present"], r["toxic"]))  # whatever order the tasks ended in
    labels_ = np.array([float(r["toxic"] > 0) for r in drawn])
    return Machine(places, *fit([r["present"] for r in drawn], labels_, len(places)))


def score(docs: DataFrame, machine: Machine, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs``, then score and predicted for its text."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")
    places = [docs.columns.index(c) for c in carry]
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # FEATURES x FACTORS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        look = Lookup(own.places)
        for batch in batches:
            scores = np.array([own.score(look.of(t)) for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in places),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= TOXIC).astype(np.int32)),
                ],
                [*carry, "score", "predicted"],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    return docs.mapInArrow(run, ", ".join([*kinds, "score double, predicted int"]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labels whose crc32(doc_id as text) mod 3 is not 1. Null and empty texts have no
    terms and get the bias as their score. Labels with a null id or value are not used; of several
    labels of one document the highest counts. Repeated rows stay rows, an empty table gives none;
    other columns are ignored.
    """
    machine = train(docs, labels.select("doc_id", "toxic"))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(rows, machine, ["doc_id", "held_out"])
