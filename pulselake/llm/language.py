"""Language identification by sparse multinomial logistic regression.

Texts are TF-IDF vectors of hashed character n-grams of one to three letters. The weights are
learned by follow-the-regularised-leader with L1 and L2 penalties, which leaves most of them at
zero, and a temperature fitted on texts held back from training calibrates the probabilities.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches, crc_bucket

BUCKETS = 1 << 16
#: Characters of a text looked at at a time; bounds memory, result-neutral but for n-grams across a cut.
PIECE = 1 << 20
#: Labelled rows that the weights are fitted on, shared evenly by the languages, and passes over them.
SAMPLE_ROWS = 6000
PASSES = 3
#: Share of them held back for the temperature.
CALIBRATION = 0.2
# Learning rate, offset, penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.0005
#: Buckets and counts of a sampled text as bytes. Big-endian, so that bytes sort as the numbers do.
PLACES, TIMES = np.dtype(">u2"), np.dtype(">u4")
MIXERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x BUCKETS
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)])
    return _LETTERS


def counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams, None for a text without a letter.

    Everything but letters counts as one space after a word.
    """
    total = None
    for at in range(0, len(text or ""), PIECE):
        raw = text[at : at + PIECE].lower().encode("utf-32-le", "replace")
        points = np.frombuffer(raw, np.uint32)
        is_letter = letters()[points]
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        if not is_letter.any():
            continue
        c = np.where(is_letter, points, 32)[keep].astype(np.uint64)
        one = (c + np.uint64(1)) * MIXERS[0]
        two = (one[:-1] ^ c[1:]) * MIXERS[1]
        three = (two[:-1] ^ c[2:]) * MIXERS[2]
        grams = np.concatenate([one, two, three]) >> np.uint64(48)
        found = np.bincount(grams.view(np.int64), minlength=BUCKETS)
        total = found if total is None else total + found
    return total


def vector(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their TF-IDF of length one."""
    at = np.flatnonzero(count)
    value = count[at] * idf[at]
    norm = np.sqrt(value @ value)
    return at, value / norm if norm else value


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            count = counts(text)
            if count is not None:
                df += count > 0
                docs += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))], ["bucket", "n"]
    )


def inverse_frequencies(labelled: DataFrame) -> np.ndarray:
    """IDF of every bucket over all labelled texts; BUCKETS numbers come to the driver."""
    rows = (
        labelled.select("text")
        .mapInArrow(_document_counts, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    df = np.zeros(BUCKETS)
    docs = 0
    for row in rows:
        if row["bucket"] < 0:
            docs = row["n"]
        else:
            df[row["bucket"]] = row["n"]
    return np.log((1 + docs) / (1 + df)) + 1


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, many = [], []
        for text in batch.column("text").to_pylist():
            count = counts(text)  # BUCKETS numbers, of one text at a time
            at = np.zeros(0, np.int64) if count is None else np.flatnonzero(count)
            places.append(at.astype(PLACES).tobytes())
            many.append(count[at].astype(TIMES).tobytes() if len(at) else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(places, pa.binary()), pa.array(many, pa.binary())], ["lang", "at", "many"]
        )


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> list:
    """At most about ``rows`` labelled texts as n-gram counts, as many of each language.

    They come to the driver as bytes, 6 for each n-gram of a text.
    """
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per language
    if not sizes:
        return []
    spark = labelled.sparkSession
    shares = spark.createDataFrame(
        [(r["lang"], min(1.0, rows / len(sizes) / r["n"])) for r in sizes], "s_lang string, share double"
    )
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    picked = labelled.join(F.broadcast(shares), F.col("lang") == F.col("s_lang")).filter(draw < F.col("share"))
    return picked.select("lang", "text").mapInArrow(_sparse, "lang string, at binary, many binary").collect()


def fit(rows: list, idf: np.ndarray) -> Model:
    """Weights by follow-the-regularised-leader, then the temperature.

    The rows are put in an order of their own first, so their order and partitions don't matter.
    """
    rows = sorted(rows, key=lambda r: (r["lang"], r["at"], r["many"]))
    names = sorted({r["lang"] for r in rows})
    known = {name: i for i, name in enumerate(names)}
    rows = [r for r in rows if r["at"]]

    def example(i: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Buckets, TF-IDF and language of a row, made when needed: all of them would take many times the bytes."""
        at = np.frombuffer(rows[i]["at"], PLACES).astype(np.int64)
        value = np.frombuffer(rows[i]["many"], TIMES) * idf[at]
        return at, value / np.sqrt(value @ value), known[rows[i]["lang"]]

    order = np.random.default_rng(7).permutation(len(rows))
    held = order[: int(len(rows) * CALIBRATION)]
    used = order[len(held) :]
    k = len(names)
    z, n = np.zeros((k, BUCKETS + 1)), np.zeros((k, BUCKETS + 1))

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[:, at]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[:, at])) / ALPHA + L2))

    for _ in range(PASSES):
        for i in used:
            at, value, y = example(i)
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)  # the last place is the bias
            w = weights(at)
            p = softmax(w @ value)
            p[y] -= 1
            g = p[:, None] * value
            sigma = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / ALPHA
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    full = weights(np.arange(BUCKETS + 1))
    model = Model(names, full[:, :BUCKETS].astype(np.float32), full[:, BUCKETS], idf, 1.0)
    if len(held):
        scores, truth = [], []
        for i in held:
            at, value, y = example(i)
            scores.append(model.weights[:, at] @ value + model.bias)
            truth.append(y)
        scores, truth = np.array(scores), np.array(truth)
        model.temperature = temperature(scores, truth)
    return model


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""

    def loss(log_t: float) -> float:
        s = scores / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(truth)), truth]))

    lo, hi, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from the learnable documents; None if there is none."""
    bounded_batches(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    drawn = sample(labelled, rows)
    if not any(r["at"] for r in drawn):
        return None
    return fit(drawn, inverse_frequencies(labelled))


def held_out() -> Column:
    """Whether a document may not be learned from."""
    return crc_bucket(F.col("doc_id"), 4) == 2


def judge(model: Model | None, text: str | None) -> tuple[str, float]:
    count = counts(text)
    if count is None or model is None:
        return "und", 0.0
    at, value = vector(count, model.idf)
    p = softmax((model.weights[:, at] @ value + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(min(1.0, p[best]))


def predict(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs``, then lang_pred and score of its text."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")
    places = [docs.columns.index(c) for c in carry]
    names = [*carry, "lang_pred", "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(shared.value, t) for t in batch.column(at).to_pylist()]
            langs = pa.array([f[0] for f in found], pa.string())
            scores = pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), langs, scores], names)

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    return docs.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double"]))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from documents with text and lang whose crc32(doc_id as text) mod 4 is not 2. A text
    that is null, empty or without a letter is ``und`` with score 0, and so is every text when
    there is nothing to learn from. A null doc_id counts as empty text. Repeated rows stay rows,
    an empty table gives none; other columns are ignored.
    """
    model = train(docs.select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model, ["doc_id", "held_out"])
